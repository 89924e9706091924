"""Long repeated word spans by compaction of a de Bruijn graph of sampled word k-mers.

A word is removed if a window of ``window`` consecutive words covers it whose sequence also starts
in a document with a smaller id.

Edges of the graph are k-mers of words, sampled by content (see anchors.py), so that every window
holds one at the same place in all its occurrences. A k-mer with its context - all words that
windows through it can reach - is one way through the graph.
1. K-mers found in one document only are dropped (partial aggregation, then a join).
2. Per context, the first source (document, position) is found. Where a document passes the same
   way as a smaller document, all windows through the k-mer are repeats. Such k-mers that follow one
   another with the same distance to the same source make a nonbranching path and are compacted
   into one span with its source coordinates.
3. A k-mer with several contexts is a branch; there the windows of each way's first document are
   compared one by one (128-bit hashes, smallest id per window), which verifies the spans' ends.

Only documents with repeated k-mers are looked at again. Null and empty texts have no words. Ids
order documents; a null id counts as larger than all others. Rows with the same id never
remove each other's words. Repeated rows give repeated result rows. Empty table: no rows. Further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.anchors import BASE, anchors, gram_hashes, merged, mixed, signed
from riskframe.llm.common import map_rows, row_key, store

K = 16
LAST = (1 << 63) - 1


def _word_values(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _edges(docs: DataFrame, window: int) -> DataFrame:
    reach = window - K

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            words = (row["text"] or b"").split()
            if len(words) < window:
                continue
            x = _word_values(words)
            pos, h = anchors(x, K, reach + 1)
            padded = np.concatenate([np.zeros(reach, np.uint64), x, np.zeros(window, np.uint64)])
            ctx = gram_hashes(padded, reach + window)[pos]
            for p, a, b in zip(pos.tolist(), signed(h), signed(ctx)):
                yield row["dk"], row["doc"], p, a, b

    return map_rows(docs, run, "dk long, doc long, pos long, h long, ctx long", chunk=1 << 15)


def repeated_spans(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, paths, windows): (dk, text) of documents with repeats, compacted spans (dk, s, e, source, source_at), and
    single repeated windows (dk, s)."""
    reach = window - K
    found = store(_edges(docs, window), "debruijn-edges")
    often = found.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h")
    again = store(found.join(often, "h"), "debruijn-repeated")
    ways = store(again.groupBy("h", "ctx").agg(F.min(F.struct("doc", "pos")).alias("first"), F.max("doc").alias("hi"))
                 .select("h", "ctx", F.col("first.doc").alias("source"), F.col("first.pos").alias("at"), "hi"), "debruijn-ways")
    passed = (again.join(ways.where("source < hi").drop("hi"), ["h", "ctx"]).where("doc > source")
              .select("dk", "pos", "source", (F.col("at") - F.col("pos")).alias("shift")))
    line = Window.partitionBy("dk", "source", "shift").orderBy("pos")
    passed = passed.withColumn("cut", (F.col("pos") - F.coalesce(F.lag("pos").over(line), F.lit(-1 << 40))
                                       > window + reach).cast("int"))
    passed = passed.withColumn("path", F.sum("cut").over(line))
    paths = store(passed.groupBy("dk", "source", "shift", "path").agg(F.min("pos").alias("s"), F.max("pos").alias("e")).select(
        "dk", F.greatest(F.col("s") - reach, F.lit(0)).alias("s"), (F.col("e") + window).alias("e"), "source",
        F.greatest(F.col("s") - reach, F.lit(0)).alias("own"), "shift").select(
        "dk", "s", "e", "source", (F.col("own") + F.col("shift")).alias("source_at")), "debruijn-paths")
    branches = ways.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    ends = (again.join(ways.join(branches, "h").select("h", "ctx", "source"), ["h", "ctx"]).where("doc = source")
            .groupBy("dk", "doc").agg(F.collect_set("pos").alias("ends")))
    held = (paths.select("dk").union(ends.select("dk"))).distinct()
    texts = store(docs.join(held, "dk"), "debruijn-texts")

    def windows(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            x = _word_values(row["text"].split())
            one = gram_hashes(x, window)
            two = gram_hashes(mixed(x ^ np.uint64(BASE)), window)
            at = np.unique(np.concatenate([np.arange(max(0, p - reach), min(p, len(one) - 1) + 1) for p in row["ends"]]))
            for s, a, b in zip(at.tolist(), signed(one[at]), signed(two[at])):
                yield row["dk"], row["doc"], s, a, b

    every = store(map_rows(texts.dropDuplicates(["dk"]).join(ends.drop("doc"), "dk"), windows,
                           "dk long, doc long, s long, a long, b long", chunk=1 << 15), "debruijn-windows")
    first = every.groupBy("a", "b").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
    single = every.join(first.drop("hi"), ["a", "b"]).where("doc > lo").select("dk", "s")
    return texts.select("dk", "text"), paths, single


def remove_repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) per row; kept is the remaining words if any were removed."""
    src = docs.select("doc_id", row_key().alias("dk"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                      F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts, paths, single = repeated_spans(src.select("dk", "doc", "text"), window)
    spans = paths.select("dk", "s", "e").union(single.select("dk", "s", (F.col("s") + window).alias("e")))
    lists = spans.groupBy("dk").agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    def cut(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            words = row["text"].split()
            runs = merged((x["s"], min(x["e"], len(words))) for x in row["spans"])
            ends = [0, *(x for run in runs for x in run), len(words)]
            left = [w for a, b in zip(ends[::2], ends[1::2]) for w in words[a:b]]
            kept = b" ".join(left)
            yield row["dk"], len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept.decode()

    def whole(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            words = row["text"].split()
            yield row["doc_id"], row["dk"], len(words), hashlib.sha256(b" ".join(words)).hexdigest()

    done = map_rows(texts.dropDuplicates(["dk"]).join(lists, "dk"), cut,
                    "dk long, n_removed long, kept_sha256 string, kept string")
    id_type = src.schema["doc_id"].dataType.simpleString()
    base = map_rows(src.select("doc_id", "dk", "text"), whole, f"doc_id {id_type}, dk long, n_words long, sha string")
    return base.join(done, "dk", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")
