"""Filter interaction audit: what every order of five filters keeps, removes and costs.

A document fails some of the filters A to E; the set is a five-bit mask. Its truth-table word has 32 bits:
bit S is set if the document survives the filters of subset S, so if S holds none that it fails. Within a
Spark partition the words of each (part, label class) are added up by carry-save adders: three words of one
weight make a sum word and a carry word of twice the weight, on all 32 positions at once, until at most two
words of each weight are left, whose bits are counted. The counters (32 per part and class, exact long
integers) are summed by Spark. They are the survivors of all 32 subsets, from which every order's figures
follow: what a step removes is the survivors of the letters before it less those with its own letter.

Filters, on whole texts (null: empty); words are maximal runs of ``[^\\x20\\x09-\\x0D]``, case-sensitive:
A: under 200 words. B: 100 * distinct words < 50 * words. C: 100 * characters A-Z > 3 * code points.
D: holds any of ``#$%&*|``. E: the text equals that of a row with a smaller doc_id, anywhere in the table.

Texts are compared by SHA-256 and byte length; the smallest id of each repeated text is found by a partial
aggregate, and only repeated texts take part in the join, so that a text that fills a third of the table is one
row on its right side and splits by AQE's skew join on its left.

Nulls: a null lang counts as part '' (with lang ''). A null doc_id is larger than any other (it fails E if a row
with an id has the same text), and has no label. Rows that repeat an id count each; a document is good or toxic
if any of its label rows says so. Empty texts fail A. A table without rows gives no rows; no labels: none lost.
Further columns are ignored. Long texts: a task holds one text and its words at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import store

LETTERS = "ABCDE"
SUBSETS = 1 << len(LETTERS)
#: Parts whose counters a task holds at once; beyond it they are sent on as partial sums.
HELD_PARTS = 4_096
#: Words added up at once.
BLOCK = 1 << 16

MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
SPACE = r"[\x20\x09-\x0D]+"


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, good, toxic, mask) per row of ``docs``: bit i of mask is set if the row fails filter i."""
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("t"))
    seen = seen.withColumn("w", F.array_remove(F.split("t", SPACE), ""))
    upper = F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))
    fails = [F.size("w") < MIN_WORDS,
             100 * F.size(F.array_distinct("w")).cast("long") < MIN_DISTINCT * F.size("w").cast("long"),
             100 * upper.cast("long") > MAX_UPPER * F.length("t").cast("long"),
             F.col("t").rlike("[#$%&*|]")]
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    rows = store(seen.select("doc_id", "part", mask.alias("mask"), F.sha2("t", 256).alias("h"),
                             F.octet_length("t").alias("n")), "audit-rows")
    # first: the smallest id of a text that several rows have; no id of its own: null (larger than any id)
    copies = rows.groupBy("h", "n").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    known = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic")))
    same = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    return (rows.join(copies, ["h", "n"], "left").join(known, "doc_id", "left")
            .select("part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
                    (F.col("mask") + F.when(same, 16).otherwise(0)).alias("mask")))


def truth_words() -> np.ndarray:
    """The truth-table word of each failure mask."""
    return np.array([sum(1 << s for s in range(SUBSETS) if not s & m) for m in range(SUBSETS)], np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit set, by carry-save adders."""
    counts, weight, level = np.zeros(32, np.int64), 1, words.astype(np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            n = len(level) // 3
            a, b, c = level[:n], level[n:2 * n], level[2 * n:3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * n:]])
        bits = np.unpackbits(level.astype("<u4").view(np.uint8), bitorder="little")
        counts += weight * bits.reshape(-1, 32).sum(axis=0, dtype=np.int64)
        level, weight = np.concatenate(carries) if carries else level[:0], weight * 2
    return counts


def survivors(failed: DataFrame) -> DataFrame:
    """(part, n, good, toxic): arrays of 32 counts, the rows of ``failures`` that survive subset S, of all, good and toxic ones."""
    words = truth_words()
    out = pa.schema([("part", pa.string()), ("kind", pa.int32()), ("counts", pa.list_(pa.int64()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}

        def emit():
            keys = list(held)
            rows = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                               pa.array([held[k].tolist() for k in keys], pa.list_(pa.int64()))], schema=out)
            held.clear()
            return rows

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                cut = batch.slice(at, BLOCK)
                part = cut.column(0).dictionary_encode()
                names, code = part.dictionary.to_pylist(), part.indices.to_numpy(zero_copy_only=False)
                kind = cut.column(1).to_numpy(zero_copy_only=False)
                word = words[cut.column(2).to_numpy(zero_copy_only=False)]
                cls = code.astype(np.int64) * 4 + kind
                order = np.argsort(cls, kind="stable")
                found, first = np.unique(cls[order], return_index=True)
                for c, own in zip(found.tolist(), np.split(word[order], first[1:])):
                    key = (names[c // 4], c % 4)
                    held[key] = held.get(key, 0) + positional_counts(own)
                if len(held) > 4 * HELD_PARTS:
                    yield emit()
        if held:
            yield emit()

    kind = (F.col("good").cast("int") + 2 * F.col("toxic").cast("int")).alias("kind")
    parts = failed.select("part", kind, "mask").mapInArrow(count, "part string, kind int, counts array<long>")
    total = lambda s, of: F.sum(F.when(of, F.get("counts", F.lit(s))).otherwise(0))
    classes = {"n": F.lit(True), "good": F.col("kind").isin(1, 3), "toxic": F.col("kind").isin(2, 3)}
    sums = parts.groupBy("part").agg(*[total(s, of).alias(f"{name}{s}") for name, of in classes.items() for s in range(SUBSETS)])
    return sums.select("part", *[F.array(*[f"{name}{s}" for s in range(SUBSETS)]).alias(name) for name in classes])


def shapley(n: str, bit: int) -> Column:
    """What the filter of ``bit`` removes, summed over all orders, from the survivors of the subsets."""
    terms = [(F.get(n, F.lit(s)) - F.get(n, F.lit(s | bit))) * (factorial(s.bit_count()) * factorial(len(LETTERS) - 1 - s.bit_count()))
             for s in range(SUBSETS) if not s & bit]
    return sum(terms[1:], terms[0])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): one row per
    part, order of the five filters and step."""
    counts = survivors(failures(docs, labels))
    counts = counts.select("*", F.array(*[shapley("n", 1 << i) for i in range(len(LETTERS))]).alias("worth"))
    steps = []
    for order in permutations(range(len(LETTERS))):
        before = 0
        for step, letter in enumerate(order):
            steps.append(F.struct(F.lit("".join(LETTERS[i] for i in order)).alias("filter_order"), F.lit(step + 1).alias("step"),
                                  F.lit(before).alias("a"), F.lit(before | 1 << letter).alias("b"), F.lit(letter).alias("f"),
                                  F.lit(1 << letter).alias("own"), F.lit(SUBSETS - 1 - (1 << letter)).alias("others")))
            before |= 1 << letter
    rows = counts.select("*", F.inline(F.array(*steps)))
    lost = lambda of: F.get(of, F.col("a")) - F.get(of, F.col("b"))
    failing = F.get("n", F.lit(0)) - F.get("n", F.col("own"))
    return rows.select(
        "part", "filter_order", "step", F.get("n", F.col("b")).alias("kept"), lost("n").alias("removed"),
        (failing - lost("n")).alias("redundant"),
        (F.get("n", F.col("others")) - F.get("n", F.lit(SUBSETS - 1))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("worth", F.col("f")).alias("shapley"))
