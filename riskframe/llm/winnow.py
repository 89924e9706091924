"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are runs of digits, a-z (after lower-casing A-Z) and everything beyond ASCII. An item's
windows are its runs of ``window`` consecutive words; an item with fewer words (but some) is one
window. A document word is hit if an occurrence of a window covers it.

Texts are fingerprinted by winnowing: hashes of all k-grams, of which the smallest of every
``window - k + 1`` consecutive ones is kept, so two texts that share ``window`` words share a
fingerprint. Fingerprints of documents and items are joined; in documents with a common one, the
k-grams with those hashes are looked up again, the words themselves are compared there, and a hit
is extended to both sides as far as the words agree (at most to the windows that hold the k-gram).
Items shorter than ``window`` are done by the same steps with their own length as the window.

Items with equal word sequences are one class until the end. Items with a null id or text take
no part, repeated item rows count once. A null or empty document has no words. Every document row
gives a row, also one that repeats id and text; a null id is kept.
Empty tables: no hits, or no rows. Further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import broadcast_stored, row_key, store

# fixed values: the separators between words
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 5


def words(text: str) -> Column:
    t = F.coalesce(F.col(text), F.lit(""))
    low = F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _grams(df: DataFrame, k: int) -> DataFrame:
    """Adds kg, the hashes of all runs of k words of the array column w (wh: the words' own hashes)."""
    df = df.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    return df.withColumn("kg", F.when(F.size("wh") >= k, F.transform(
        F.sequence(F.lit(0), F.size("wh") - k), lambda i: F.xxhash64(*[F.get("wh", i + j) for j in range(k)])))
        .otherwise(F.array().cast("array<bigint>"))).drop("wh")


def _minima(df: DataFrame, span: int) -> DataFrame:
    """Adds mins, the distinct smallest hashes of every ``span`` consecutive ones of kg."""
    if span == 1:
        return df.withColumn("mins", F.array_distinct("kg"))
    return df.withColumn("mins", F.when(F.size("kg") >= span, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size("kg") - span), lambda i: F.least(*[F.get("kg", i + j) for j in range(span)]))))
        .otherwise(F.array().cast("array<bigint>")))


def _contexts(window: int, k: int, at: Column) -> tuple[Column, Column, Column]:
    """Of the k-gram that starts at word ``at``: the words before it, nearest first, its own, those after it."""
    side = window - k
    before = F.greatest(at - side, F.lit(0))
    return (F.reverse(F.slice("w", before + 1, at - before)), F.slice("w", at + 1, F.lit(k)),
            F.slice("w", at + k + 1, F.lit(side)))


def _agree(a: str, b: str) -> Column:
    """How many leading elements two arrays share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def _hits(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(doc_id, tk, s, e, cls): spans [s, e) of document words that windows of one length cover."""
    # explode_outer: for explode the optimizer would infer a filter on the array and compute it anew below
    k = min(K, window)
    marks = _minima(_grams(items, k), window - k + 1)
    marks = marks.select("cls", "w", "kg", "mins", F.explode_outer(F.sequence(F.lit(0), F.size("kg") - 1)).alias("i")).where(
        F.array_contains("mins", F.get("kg", F.col("i"))))
    left, own, right = _contexts(window, k, F.col("i"))
    marks = store(marks.select("cls", F.get("kg", F.col("i")).alias("hash"), left.alias("i_left"), own.alias("i_own"),
                               right.alias("i_right")).distinct(), "benchmark-fingerprints")
    hashes = broadcast_stored(store(marks.select("hash").distinct(), "benchmark-hashes"))
    split = docs.select("doc_id", "tk", words("text").alias("w"))
    seen = _minima(_grams(split, k), window - k + 1).select("doc_id", "tk", F.explode_outer("mins").alias("hash"))
    common = seen.join(hashes, "hash").groupBy("doc_id", "tk").agg(F.collect_set("hash").alias("common"))
    again = docs.alias("d").join(common.alias("c"), F.expr("d.doc_id <=> c.doc_id and d.tk = c.tk")).select(
        "d.doc_id", "d.tk", "d.text", "c.common")
    again = _grams(again.select("doc_id", "tk", "common", words("text").alias("w")), k)
    spots = again.withColumn("spots", F.filter(F.sequence(F.lit(0), F.size("kg") - 1),
                                               lambda i: F.array_contains("common", F.get("kg", i))))
    spots = spots.select("doc_id", "tk", "w", "kg", F.explode_outer("spots").alias("i"))
    left, own, right = _contexts(window, k, F.col("i"))
    spots = spots.select("doc_id", "tk", "i", F.get("kg", F.col("i")).alias("hash"), left.alias("left"),
                         own.alias("own"), right.alias("right"))
    met = spots.join(broadcast_stored(marks), "hash").where(F.col("own") == F.col("i_own"))
    met = met.withColumn("l", _agree("left", "i_left")).withColumn("r", _agree("right", "i_right"))
    return met.where(F.col("l") + F.col("r") + k >= window).select(
        "doc_id", "tk", (F.col("i") - F.col("l")).alias("s"), (F.col("i") + k + F.col("r")).alias("e"), "cls").distinct()


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, spans, classes): rows (doc_id, tk, n_words); spans (doc_id, tk, s, e, cls), stored; classes (cls, item_id)."""
    src = docs.select("doc_id", row_key().alias("tk"), "text")
    items = benchmark.where("item_id is not null and text is not null").select(
        "item_id", words("text").alias("w")).where(F.size("w") > 0).distinct()
    items = store(items.withColumn("cls", F.sha2(F.concat_ws(" ", "w"), 256)), "benchmark-words")
    classes = items.select("cls", "item_id").distinct()
    texts = items.select("cls", "w").dropDuplicates(["cls"]).withColumn("t", F.least(F.size("w"), F.lit(window)))
    lengths = sorted(r[0] for r in texts.select("t").distinct().collect())  # at most ``window`` values
    found = [_hits(src, texts.where(F.col("t") == t).drop("t"), t) for t in lengths]
    none = src.limit(0).select("doc_id", "tk", F.lit(0).alias("s"), F.lit(0).alias("e"), F.lit("").alias("cls"))
    spans = store(reduce(DataFrame.union, found, none), "benchmark-hits")
    rows = src.select("doc_id", "tk", F.size(words("text")).cast("long").alias("n_words"))
    return rows, spans, classes


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document."""
    rows, spans, classes = contaminated_spans(docs, benchmark, window)
    hit = (spans.select("doc_id", "tk", "s", "e").distinct()
           .select("doc_id", "tk", F.explode(F.sequence(F.col("s"), F.col("e") - 1)).alias("at"))
           .groupBy("doc_id", "tk").agg(F.count_distinct("at").alias("n_hit")))
    listed = (spans.select("doc_id", "tk", "cls").distinct().join(classes, "cls")
              .select("doc_id", "tk", F.col("item_id").cast("string").alias("item")).distinct()
              .groupBy("doc_id", "tk").agg(F.count("item").alias("n_items"),
                                           F.concat_ws(",", F.array_sort(F.collect_list("item"))).alias("items")))
    both = F.expr("a.doc_id <=> b.doc_id and a.tk = b.tk")
    marked = hit.alias("a").join(listed.alias("b"), both).select("a.doc_id", "a.tk", "n_hit", "n_items", "items")
    return rows.alias("a").join(marked.alias("b"), both, "left").select(
        "a.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` (all columns) that no window occurs in."""
    _, spans, _ = contaminated_spans(docs, benchmark, window)
    bad = spans.select("doc_id", "tk").distinct()
    keyed = docs.withColumn("__tk", row_key())
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad["doc_id"]) & (keyed["__tk"] == bad["tk"]), "left_anti").drop("__tk")
