"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Words are runs of bytes other than ASCII white space after lower-casing A-Z; shingles are
``width`` words joined by spaces (all words if there are fewer), repeats included; each shingle
is hashed with XXH64. A fingerprint bit is 1 if it is set in over half of the hashes.

Fingerprints at most ``max_bits`` apart are linked. The 64 bits are cut into ``max_bits + 3``
blocks; a linked pair agrees on at least three of them, so joining on every choice of three
blocks (27 bits and more) meets every pair, and the distance is then verified. Only distinct
fingerprints are joined: copies meet in a partial aggregation first.

A null or empty text has the fingerprint zero, linked like any other. Repeated rows give repeated
result rows; a null id takes part and is never the smallest id unless its component has no
other. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import map_rows, row_key, shuffled, store
from riskframe.llm.components import connected_components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: bytes, width: int, seed: int = 42, chunk: int = 1 << 14) -> int:
    """The unsigned 64-bit fingerprint; hashes are summed ``chunk`` at a time."""
    import xxhash

    words = text.translate(LOWER).split()  # bytes.split() knows ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    stops = (ends - 1).tolist()
    w = min(width, len(words))
    n = len(words) - w + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, chunk):
        to = min(n, at + chunk)
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:to], stops[at + w - 1:to + w - 1])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) with fp as a signed long, one row per row of ``docs``."""
    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            fp = simhash(row["text"] or b"", width)
            yield row["id"], fp - (1 << 64) if fp >> 63 else fp

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_rows(src, run, f"id {src.schema['id'].dataType.simpleString()}, fp long")


def linked_pairs(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) of every two values of ``distinct``.fp at most ``max_bits`` apart, a < b."""
    n = max_bits + 3
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n)]
    masks = [sum(c) for c in combinations(blocks, 3)]
    keys = F.array(*[F.xxhash64(F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)), F.lit(i))
                     for i, m in enumerate(masks)])
    rows = distinct.select("fp", F.explode_outer(keys).alias("key"))
    a, b = rows.select("key", F.col("fp").alias("a")), rows.select("key", F.col("fp").alias("b"))
    return (a.join(shuffled(b), "key").where((F.col("a") < F.col("b"))
                                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .select("a", "b").distinct())


def rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(fp, least, root) of ``distinct`` (fp, least): root is the same for all fingerprints of a component."""
    roots = connected_components(linked_pairs(distinct.select("fp"), max_bits))
    return distinct.join(shuffled(roots.withColumnRenamed("node", "fp")), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id): component_id is the smallest id reachable over links."""
    prints = store(fingerprints(docs, width, id_col, text_col), "fingerprints")
    named = rooted(prints.groupBy("fp").agg(F.min("id").alias("least")), max_bits)
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(shuffled(heads), "root").select("fp", "component_id")
    return prints.join(shuffled(classes), "fp").select(F.col("id").alias(id_col),
                                             F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` (all columns) of each component: the one with the smallest id, null ids last. Of several
    texts under that id the one with the smallest row key is kept; rows that repeat id and text count as one."""
    none = F.col("doc_id").isNull()
    rows = docs.withColumn("__row", F.struct(none.alias("none"), F.col("doc_id").alias("id"), row_key().alias("key")))
    prints = store(fingerprints(rows, width, "__row"), "fingerprints")
    named = rooted(prints.groupBy("fp").agg(F.min("id").alias("least")), max_bits)
    heads = named.groupBy("root").agg(F.min("least").alias("__row")).select("__row")
    return rows.join(shuffled(heads), "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")
