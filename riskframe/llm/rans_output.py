"""Token-id files coded with a static range asymmetric numeral system (rANS).

Documents are sorted by id, encoded with a public tokenizer, and an end id is appended to each.
One frequency table over the whole corpus is shared by all files. A file holds independent
blocks of whole documents; a block's ids are dealt to interleaved lanes (64-bit states, 32-bit
words) that are coded side by side. Each block carries the documents' ids and lengths and
checksums of its bytes and its ids; the list of block offsets is the checkpoint from which
any block can be decoded alone, so files are read back a block a task at a time.

Null and empty texts hold the end id only. Repeated rows are documents of their own (rows with the same
id lie in the order of their texts' hashes); null ids come first. Empty table: no rows. Further columns are ignored.
Texts are encoded in groups of about GROUP_BYTES: Arrow cuts them at white space and numbers the distinct chunks, each
distinct chunk of a group is looked up once, and one gather lays the ids out. A longer text goes in pieces that end at
white space. A task holds one block, or a group, a text and its ids; ids of chunks of at most CHUNK_BYTES are remembered,
by a Python worker over its tasks, for at most 2 x CACHE chunks and those of one group.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, map_rows, store
from riskframe.llm.warc import file_system
from riskframe.session import scratch_path

SCALE = 20
LANES = 2_048
BLOCK_TOKENS = 1 << 19
FILE_BYTES = 128 << 20
CACHE = 500_000
#: Longer chunks are not remembered.
CHUNK_BYTES = 256
#: Texts encoded at once, in bytes; a longer text is cut at white space.
GROUP_BYTES = 8 << 20
#: Where texts may be cut: ASCII white space.
GAP = re.compile(b"[ \t\n\r\x0b\x0c]")
#: Tasks that add up the parts' counters (a few hundred KB each).
COUNTER_TASKS = 4
MAGIC = b"RANSTOK1"
HEAD = "<8sIIIIIII"  # magic, table crc, documents, tokens, lanes, words, crc of ids, crc of the rest


class ChunkEncoder:
    """Ids of a text by way of its chunks between ASCII white space, for tokenizers that drop white space.

    The tokenizer cuts at white space before anything else, so a text's ids are its chunks' ids in
    order. It then cuts a chunk into runs of letters, digits and runs of other marks; those of ASCII and
    Latin-1 letters, digits and ASCII marks go to the library's merge model directly (lower-cased, as bytes
    mapped to letters). Chunks with apostrophes (contractions), with marks of added tokens (which hold some) or
    with any other character take the library's whole path.
    """

    UPPER = re.compile(b"\xc3[\x80-\x96\x98-\x9e]")

    def __init__(self, tokenizer_json: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tok, self.most = Tokenizer.from_str(tokenizer_json), cache
        self.chunks: dict[bytes, bytes] = Chunks(self)
        self.older: dict[bytes, bytes] = {}  # what was known before the last time that chunks was full
        self.packed = [struct.pack("<I", i) for i in range(self.tok.get_vocab_size(with_added_tokens=True))]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.letters = "".join(letter[b] for b in range(256))

        added = "'" + "".join(t.content for t in self.tok.get_added_tokens_decoder().values())
        marks = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in added)
        self.part = re.compile(b"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[" + re.escape(marks) + b"]+")
        self.merge = self.tok.model.tokenize
        self.marks = {c: self._merge(bytes([c])) for c in marks}

    def _merge(self, part: bytes) -> bytes:
        shown = part.decode() if part.isascii() else part.decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.merge(shown)])

    def _plain(self, chunk: bytes) -> bytes | None:
        low = chunk.lower()  # A-Z only
        if low.isalpha():  # a-z only
            return self._merge(low) if low == chunk else self.chunks[low]
        if low[:-1].isalpha() and low[-1] in self.marks:
            return self.chunks[low[:-1]] + self.marks[low[-1]]
        if not low.isascii():
            low = self.UPPER.sub(lambda m: bytes((m[0][0], m[0][1] + 32)), low)
        parts = self.part.findall(low)
        if b"".join(parts) != low:
            return None
        if len(parts) > 1:
            return b"".join(map(self.chunks.__getitem__, parts))
        return self._merge(low) if low == chunk else self.chunks[low]

    def encoded(self, chunk: bytes) -> bytes:
        """The ids of a chunk that is not among the known ones."""
        ids = self.older.get(chunk) or self._plain(chunk)
        if ids is None:
            ids = b"".join([self.packed[i] for i in self.tok.encode(chunk.decode(), add_special_tokens=False).ids])
        return ids

    def group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; how many each text has)."""
        if len(self.chunks) > self.most:
            self.older, self.chunks = self.chunks, Chunks(self)
        split = pc.ascii_split_whitespace(texts)  # gives empty chunks at the ends, which have no ids
        numbered = split.flatten().dictionary_encode()
        known = list(map(self.chunks.__getitem__, numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()))
        pool, size = np.frombuffer(b"".join(known), "<u4"), np.array(list(map(len, known)), np.int64) // 4
        at = numbered.indices.to_numpy()
        n = size[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat((np.cumsum(size) - size)[at] - ends[:-1], n)
        take += np.arange(len(take))
        per_text = pc.list_value_length(split).to_numpy()
        return pool[take], np.diff(ends[np.concatenate([[0], np.cumsum(per_text)])])

    def groups(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of texts, their ids, how many each has) for runs of ``texts``, none of them null, in order."""
        size = pc.binary_length(texts).to_numpy().astype(np.int64)
        start = 0
        while start < len(texts):
            if size[start] > GROUP_BYTES:
                parts = [self.group(pa.array([p]).cast(pa.string()))[0] for p in pieces(texts[start].as_buffer().to_pybytes())]
                ids, stop = np.concatenate(parts), start + 1
                yield 1, ids, np.array([len(ids)], np.int64)
            else:
                stop = start + max(1, int(np.searchsorted(np.cumsum(size[start:]), GROUP_BYTES, "right")))
                yield stop - start, *self.group(texts.slice(start, stop - start))
            start = stop


def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut at the first white space after every GROUP_BYTES."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + GROUP_BYTES)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


class Chunks(dict):
    """Chunk -> its ids; asks the encoder for those that it does not hold."""

    def __init__(self, encoder: ChunkEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.encoder.encoded(chunk) if chunk else b""
        if len(chunk) <= CHUNK_BYTES:
            self[chunk] = ids
        return ids


#: The encoder of the Python worker: tasks that follow each other in one worker find its chunks known.
_ENCODER: dict[bytes, ChunkEncoder] = {}


def worker_encoder(tokenizer_json: str) -> ChunkEncoder:
    key = hashlib.sha256(tokenizer_json.encode()).digest()
    if key not in _ENCODER:
        _ENCODER.clear()  # one at a time
        _ENCODER[key] = ChunkEncoder(tokenizer_json)
    return _ENCODER[key]


def shared_table(counts: dict[int, int], scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, frequencies) whose sum is 2**scale, at least 1 for every symbol that occurs."""
    symbols = np.array(sorted(counts), np.int64)
    n = np.array([counts[int(s)] for s in symbols], float)
    m = 1 << scale
    if len(symbols) > m // 2:
        raise ValueError(f"{len(symbols)} different ids do not fit a table of 2**{scale}")
    freq = np.maximum(1, np.floor(n / n.sum() * m)).astype(np.int64)
    left = m - int(freq.sum())
    if left > 0:
        freq[np.argmax(freq)] += left
    for i in np.argsort(-freq, kind="stable") if left < 0 else ():
        cut = min(-left, int(freq[i]) // 2)
        freq[i], left = freq[i] - cut, left + cut
        if not left:
            break
    return symbols, freq


class Coder:
    def __init__(self, symbols: np.ndarray, freq: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.mask = np.uint64((1 << scale) - 1)
        self.symbols = symbols.astype("<u4")
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.place = np.full(int(self.symbols.max(initial=0)) + 1, len(symbols), np.uint32)  # of a symbol; past the end: none
        self.place[self.symbols] = np.arange(len(symbols), dtype=np.uint32)
        self.slots = np.repeat(np.arange(len(symbols), dtype=np.uint32), freq)
        self.crc = zlib.crc32(self.symbols.tobytes() + freq.astype("<u4").tobytes())
        self.low, self.word = np.uint64(1 << 31), np.uint64(32)
        self.top = np.uint64(63 - scale)

    def encode(self, ids: np.ndarray, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
        """(lane states, words) of at least one id."""
        at = self.place[ids]
        lanes = min(lanes, len(ids))
        x, out = np.full(lanes, self.low), []
        for start in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
            s = at[start:start + lanes]
            f, own = self.freq[s], x[:len(s)]
            full = own >= (f << self.top)
            out.append(own[full].astype("<u4"))
            own = np.where(full, own >> self.word, own)
            q = own // f
            x[:len(s)] = (q << self.scale) + (own - q * f) + self.cum[s]
        return x, np.concatenate(out[::-1])

    def decode(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        x, lanes, used = states.copy(), len(states), 0
        ids = np.empty(n, np.uint32)
        for start in range(0, n, lanes):
            own = x[:min(lanes, n - start)]
            slot = own & self.mask
            s = self.slots[slot]
            ids[start:start + len(s)] = s
            own = self.freq[s] * (own >> self.scale) + slot - self.cum[s]
            short = np.flatnonzero(own < self.low)
            own[short] = (own[short] << self.word) | words[used:used + len(short)]
            used += len(short)
            x[:len(s)] = own
        if used != len(words) or (x != self.low).any():
            raise ValueError("a block does not decode to its start state")
        return self.symbols[ids]

    def block(self, docs: list[tuple[int | None, bytes]]) -> bytes:
        raw = b"".join(d[1] for d in docs)
        ids = np.frombuffer(raw, "<u4")
        states, words = self.encode(ids)
        rest = (np.array([d[0] or 0 for d in docs], "<i8").tobytes() + bytes(d[0] is None for d in docs)
                + np.array([len(d[1]) // 4 for d in docs], "<u4").tobytes() + states.astype("<u8").tobytes() + words.tobytes())
        return struct.pack(HEAD, MAGIC, self.crc, len(docs), len(ids), len(states), len(words), zlib.crc32(raw), zlib.crc32(rest)) + rest

    def unblock(self, data: bytes) -> Iterator[tuple[int | None, bytes]]:
        """(id, ids as bytes) of a block's documents, after its checks."""
        magic, table, n_docs, n, lanes, n_words, crc_ids, crc = struct.unpack_from(HEAD, data)
        rest = data[struct.calcsize(HEAD):]
        if magic != MAGIC or table != self.crc or zlib.crc32(rest) != crc:
            raise ValueError("a block is damaged or belongs to another table")
        doc = np.frombuffer(rest, "<i8", n_docs)
        null = rest[8 * n_docs:9 * n_docs]
        at = 9 * n_docs
        size = np.frombuffer(rest, "<u4", n_docs, at)
        states = np.frombuffer(rest, "<u8", lanes, at + 4 * n_docs)
        words = np.frombuffer(rest, "<u4", n_words, at + 4 * n_docs + 8 * lanes).astype(np.uint64)
        raw = self.decode(states, words, n).astype("<u4").tobytes()
        if zlib.crc32(raw) != crc_ids:
            raise ValueError("decoded ids differ from those that were written")
        start = 0
        for d, is_null, k in zip(doc.tolist(), null, size.tolist()):
            yield (None if is_null else d), raw[4 * start:4 * (start + k)]
            start += k


def encode_documents(docs: DataFrame, tokenizer_json: str, end_id: int) -> tuple[DataFrame, dict[int, int]]:
    """(part, seq, doc_id, ids), stored, in ascending id order over parts and rows; and how often each id occurs.

    The occurrences are counted in the same pass: a part's last row (seq -1) holds its counters, one per id of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, end = TaskContext.get().partitionId(), worker_encoder(tokenizer_json), np.uint32(end_id)
        seen, seq = np.zeros(0, np.int64), 0

        def rows(seqs: np.ndarray, doc_ids: pa.Array, ids: pa.Array) -> pa.RecordBatch:
            parts = pa.array(np.full(len(seqs), part, np.int32))
            return pa.RecordBatch.from_arrays([parts, pa.array(seqs), doc_ids, ids], ["part", "seq", "doc_id", "ids"])

        for batch in batches:
            texts, start = pc.fill_null(batch.column("text"), ""), 0
            for m, ids, n in enc.groups(texts):
                ids = np.insert(ids, np.cumsum(n), end)  # after each text
                counted = np.bincount(ids, minlength=len(seen))
                counted[:len(seen)] += seen
                seen = counted
                bounds = np.concatenate([[0], np.cumsum(4 * (n + 1))]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype("<u4"))])
                yield rows(np.arange(seq, seq + m), batch.column("doc_id").slice(start, m), packed)
                start, seq = start + m, seq + m
        if len(seen):
            yield rows(np.array([-1]), pa.nulls(1, pa.int64()), pa.array([seen.astype("<i8").tobytes()], pa.binary()))

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = src.repartitionByRange(F.asc_nulls_first("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    bounded_batches(docs.sparkSession)
    whole = store(order.mapInArrow(run, "part int, seq long, doc_id long, ids binary"), "token-ids")

    def spread(rows: Iterator[dict]) -> Iterator[tuple]:
        total = np.zeros(0, np.int64)
        for row in rows:
            n = np.frombuffer(row["ids"], "<i8")
            if len(n) > len(total):
                total, n = n.copy(), total
            total[:len(n)] += n
        yield from ((int(i), int(total[i])) for i in np.flatnonzero(total))

    # one row for each id of the vocabulary, which bounds what the driver gets
    counters = whole.where("seq = -1").select("ids").coalesce(COUNTER_TASKS)
    counts = map_rows(counters, spread, "id long, n long").groupBy("id").agg(F.sum("n"))
    return whole.where("seq >= 0"), dict(counts.collect())


def write_files(encoded: DataFrame, coder: Coder, folder: str) -> DataFrame:
    """(path, part, file, block, offset, length) of every block: the checkpoints, stored."""
    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        fs, root = file_system(folder)
        state: dict = {"out": None}

        def flush(docs: list, part: int) -> tuple:
            if state["out"] is None:
                fs.create_dir(root)
                state.update(name=f"ids-{part:06d}-{uuid.uuid4().hex}.rans", at=0)
                state["out"] = fs.open_output_stream(f"{root}/{state['name']}", compression=None)
            data = coder.block(docs)
            state["out"].write(data)
            found = (f"{folder}/{state['name']}", part, state["seq"], state["at"], len(data))
            state["at"] += len(data)
            if state["at"] >= FILE_BYTES:
                state["out"].close()
                state["out"] = None
            return found

        held, tokens, part = [], 0, None
        for row in rows:
            if held and (row["part"] != part or tokens >= BLOCK_TOKENS):
                yield flush(held, part)
                held, tokens = [], 0
            if row["part"] != part and state["out"] is not None:
                state["out"].close()
                state["out"] = None
            if not held:
                part, state["seq"] = row["part"], row["seq"]
            held.append((row["doc_id"], row["ids"]))
            tokens += len(row["ids"]) // 4
        if held:
            yield flush(held, part)
        if state["out"] is not None:
            state["out"].close()

    return store(map_rows(encoded.select("part", "seq", "doc_id", "ids"), run,
                          "path string, part int, seq long, at long, length long", chunk=1), "token-checkpoints")


def read_files(checkpoints: DataFrame, coder: Coder) -> DataFrame:
    """(part, seq, row, doc_id, n_tokens, ids_crc32) of every document, decoded from the files block by block."""
    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            fs, path = file_system(r["path"])
            with fs.open_input_file(path) as source:
                data = source.read_at(r["length"], r["at"])
            for i, (doc, ids) in enumerate(coder.unblock(data)):
                yield r["part"], r["seq"], i, doc, len(ids) // 4, zlib.crc32(ids)

    n = max(1, checkpoints.count())
    dealt = checkpoints.repartition(min(n, 4 * checkpoints.sparkSession.sparkContext.defaultParallelism), "path", "at")
    return map_rows(dealt, run, "part int, seq long, row long, doc_id long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_json: str, end_id: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the written files."""
    spark = docs.sparkSession
    encoded, counts = encode_documents(docs, tokenizer_json, end_id)
    if not counts:
        return encoded.select("doc_id", F.lit(0).cast("long").alias("start"), F.col("seq").alias("n_tokens"),
                              F.col("seq").alias("ids_crc32"))
    coder = Coder(*shared_table(counts))
    folder = scratch_path(spark, "token-files")
    rows = store(read_files(write_files(encoded, coder, folder), coder), "token-rows")
    blocks = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each written part, not for each document
    parts = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("p0"))
    blocks = blocks.select("part", "seq", F.coalesce(F.sum("n").over(
        Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b0"))
    inside = F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("part", "seq").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.withColumn("r0", inside).join(blocks, ["part", "seq"]).join(parts, "part")
            .select("doc_id", (F.col("p0") + F.col("b0") + F.col("r0")).cast("long").alias("start"), "n_tokens", "ids_crc32"))
