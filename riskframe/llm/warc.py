"""WARC archives: write, normalise monolithic gzip to one member per record, read back by index.

Pages become records: the payload is the page's html in UTF-8 inside an HTTP response block. Of
records whose payloads are equal and at least ``least_bytes`` long, the one with the smallest id
is a response, the others are revisits of it that carry no payload; smaller payloads are all
responses. Archives are first written as one gzip stream over the whole file. The normaliser
inflates such a stream once, in pieces, writes every record as a gzip member of its own, and
beside the archive a sidecar index with a line (offset, length, record id) for each. Records are then read by
offset, and payload digests are checked against the bytes.

Files lie under the shared checkpoint folder. A task names its files uniquely, and only names
that a finished task returned are read, so repeated attempts do no harm. Tasks hold one record
and a buffer.

Null html is an empty payload, a null url is written as the record's own id, a null id stays
null (and revisits a page with an id if payloads are equal). Repeated rows with the same id give a
record each, of the same type. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import map_rows, store
from riskframe.session import scratch_path

ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 18
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str):
    """(pyarrow file system, path) for a local, file:, hdfs:, s3: or gs: address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def record(rid: str, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit without payload. Ids are page ids as text."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = quote(url, safe="/:?#[]@!$&'()*+,;=%~-._") if url else f"urn:x-page:{rid}"
    more = (f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:{refers_to}>\r\n" if refers_to is not None else "")
    head = (f"WARC/1.1\r\nWARC-Type: {'response' if refers_to is None else 'revisit'}\r\n"
            f"WARC-Record-ID: <urn:x-page:{rid}>\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: {target}\r\n"
            f"WARC-Payload-Digest: sha256:{digest}\r\n{more}Content-Type: application/http; msgtype=response\r\n"
            f"Content-Length: {len(block)}\r\n\r\n")
    return head.encode() + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of a stream of bytes; raises if the stream ends inside one."""
    held = bytearray()
    need = 0
    for piece in pieces:
        held += piece
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(headers(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError(f"the archive ends inside a record ({len(held)} bytes left)")


def inflate(stream, piece: int = PIECE) -> Iterator[bytes]:
    """The bytes of a gzip stream of one or several members, at most about ``piece`` at a time."""
    z = zlib.decompressobj(31)
    fresh = True
    while data := stream.read(piece):
        while data:
            fresh = False
            yield z.decompress(data, piece)
            data = z.unconsumed_tail
            if z.eof:
                data, z, fresh = z.unused_data, zlib.decompressobj(31), True
    if not fresh:
        raise ValueError("the gzip stream is cut off")


def typed_pages(pages: DataFrame, least_bytes: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, payload, size, digest, refers_to): refers_to is null for responses."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    groups = (src.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first"))
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    # short payloads never match a digest of a long one, so they stay spread by their own digest; a salt spreads equal ones
    key = F.when(F.col("size") >= least_bytes, F.col("digest")).otherwise(F.concat(F.lit("~"), F.xxhash64("id", "url")))
    return (src.withColumn("key", key).join(groups.withColumnRenamed("digest", "key"), "key", "left")
            .select("id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", "digest",
                    F.when(again, F.col("first").cast("string")).alias("refers_to")))


def write_archives(typed: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes one-stream gzip archives; (path, n_records) of each, as a stored manifest."""
    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        fs, root = file_system(folder)
        out = None
        for row in rows:
            if out is None:
                name, size, n, z = f"raw-{uuid.uuid4().hex}.warc.gz", 0, 0, zlib.compressobj(1, zlib.DEFLATED, 31)
                fs.create_dir(root)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            rid = "" if row["id"] is None else str(row["id"])
            data = record(rid, row["url"], row["payload"] or b"", row["size"], row["digest"], row["refers_to"])
            out.write(z.compress(data))
            size, n = size + len(data), n + 1
            if size >= archive_bytes:
                out.write(z.flush())
                out.close()
                out = None
                yield f"{folder}/{name}", n
        if out is not None:
            out.write(z.flush())
            out.close()
            yield f"{folder}/{name}", n

    return store(map_rows(typed, run, "path string, n_records long", chunk=1), "warc-manifest")


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites each archive (column path) with a member per record; (path, index, n_records), stored."""
    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            fs, path = file_system(row["path"])
            own_fs, root = file_system(folder)
            own_fs.create_dir(root)
            name = f"records-{uuid.uuid4().hex}.warc.gz"
            at = n = 0
            with fs.open_input_stream(path, compression=None) as source, \
                    own_fs.open_output_stream(f"{root}/{name}", compression=None) as out, \
                    own_fs.open_output_stream(f"{root}/{name}.idx", compression=None) as index:
                for data in records(inflate(source)):
                    z = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = z.compress(data) + z.flush()
                    out.write(member)
                    index.write(f"{at} {len(member)} {headers(data[:data.index(b'\r\n\r\n')])['warc-record-id']}\n".encode())
                    at, n = at + len(member), n + 1
            yield f"{folder}/{name}", f"{folder}/{name}.idx", n

    dealt = archives.select("path").repartition(max(1, archives.count()), "path")
    return store(map_rows(dealt, run, "path string, index string, n_records long", chunk=1), "warc-normalised")


def read_records(normalised: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) by the sidecar indexes."""
    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            fs, path = file_system(row["path"])
            index_fs, index_path = file_system(row["index"])
            with fs.open_input_file(path) as source, index_fs.open_input_stream(index_path, compression=None) as index:
                held = b""
                while piece := index.read(PIECE):
                    *lines, held = (held + piece).split(b"\n")
                    for line in lines:
                        at, size, rid = line.decode().split(" ", 2)
                        data = zlib.decompress(source.read_at(int(size), int(at)), 31)
                        head, _, block = data.partition(b"\r\n\r\n")
                        h = headers(head)
                        http, _, payload = block[:int(h["content-length"])].partition(b"\r\n\r\n")
                        digest, kind = h["warc-payload-digest"].removeprefix("sha256:"), h["warc-type"]
                        length = int(headers(http)["content-length"])
                        if h["warc-record-id"] != rid or kind == "response" and (
                                len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"record {rid} of {row['path']} is damaged")
                        page, refers = (x.removeprefix("<urn:x-page:").removesuffix(">") or None
                                        for x in (rid, h.get("warc-refers-to", "")))
                        yield page, length, digest, kind, refers

    rows = map_rows(normalised.repartition(max(1, normalised.count()), "path"), run,
                    "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return rows.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def archive_pages(pages: DataFrame, least_bytes: int = 100, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """Writes, normalises and reads back all of ``pages``; a row for each."""
    folder = scratch_path(pages.sparkSession, "warc")
    written = write_archives(typed_pages(pages, least_bytes, id_col, url_col, html_col), folder)
    return read_records(normalise(written, folder), pages.schema[id_col].dataType.simpleString()).withColumnRenamed(
        "page_id", id_col)
