"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame functions only.

Weights go to sources in order of their names (null last), the list repeating. Targets share
``share`` times the corpus by weight; a target stops at ``limit`` times its source's size and the
excess is shared anew by weight (water filling).

Each source's documents are shuffled by a hash of their id and laid end to end; the stream is cut
into blocks of ``block`` words. Slots are points of the golden-ratio sequence mapped through the
cumulative targets, so at any moment every source is close to its share; slots are ranked per
source, and the slot of rank r takes block r modulo the number of blocks (the last slot of a
source only as much as reaches its target). Points beyond a source's number of slots are void, and
the few slots that the points left over are appended at the end. Ranks and running sums are
taken in buckets with offsets, so no task holds a whole source.

A null or empty text has size 0 and nothing is taken of it. Repeated rows are documents of their
own. Sources without words get the target 0. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import shuffled, store

# fixed values: the fractional part of the golden ratio; ASCII white space
GOLDEN = 0.6180339887498949
SPACES = r"[\x20\x09-\x0D]+"
BLOCK = 512
BUCKET_ROWS = 32_768
CELLS = 4_096


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACES), "")), F.lit(0)).cast("long")


def _key() -> Column:
    """A digest of a row's id, source and text; rows share it only if they repeat all three."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("doc_id", "source")],
                             F.md5(F.coalesce("text", F.lit("\x00")))))


def _before(df: DataFrame, part: list[str], bucket: str, order: list, value: Column, name: str) -> DataFrame:
    """Adds the exclusive running sum of ``value`` in the order (bucket, order) within ``part``."""
    df = df.withColumn("__v", value)
    sums = df.groupBy(*part, bucket).agg(F.sum("__v").alias("__s"))
    ahead = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__o", F.coalesce(F.sum("__s").over(ahead), F.lit(0))).drop("__s")
    inside = Window.partitionBy(*part, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("__i", F.coalesce(F.sum("__v").over(inside), F.lit(0))).join(sums, [*part, bucket])
            .withColumn(name, (F.col("__o") + F.col("__i")).cast("long")).drop("__v", "__i", "__o"))


def targets(sizes: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(src, source, source_size, n_docs, target) from (source, size); one row per source.

    ``src`` numbers the sources. The windows here run over the table of sources, not documents.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    every = Window.orderBy(F.asc_nulls_last("source"))
    by = by.withColumn("src", F.row_number().over(every) - 1)
    by = by.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("src") % len(weights)))
    by = by.withColumn("cap", F.col("source_size") * F.lit(limit))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    level = Window.orderBy(F.col("cap") / F.col("w"), "src")  # sources reach their limit in this order
    below, rest = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(0, Window.unboundedFollowing)
    by = by.withColumn("rate", (total - F.coalesce(F.sum("cap").over(below), F.lit(0.0))) / F.sum("w").over(rest))
    found = F.min(F.when(F.col("rate") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "src", "rate"))
                  ).over(Window.partitionBy())["rate"]
    return by.withColumn("target", F.least(F.col("cap"), F.coalesce(found, F.lit(0.0)) * F.col("w"))).select(
        "src", "source", "source_size", "n_docs", "target")


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, src, rank, block, words): which block of which source each slot of the mix takes, and how much."""
    spark = sources.sparkSession
    size, goal = F.col("source_size"), F.floor("target").cast("long")
    blocks = F.ceil(size / F.lit(block)).cast("long")
    src = (sources.where("source_size > 0").withColumn("goal", goal).withColumn("blocks", blocks)
           .withColumn("rest", F.col("goal") % size)
           .withColumn("slots", F.expr("goal div source_size") * blocks
                       + F.ceil(F.col("rest") / F.lit(block)).cast("long")))
    every = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    src = src.withColumn("hi", F.sum("slots").over(every)).withColumn("n", F.sum("slots").over(Window.partitionBy()))
    src = store(src.withColumn("lo", (F.col("hi") - F.col("slots")) / F.col("n")).withColumn("hi", F.col("hi") / F.col("n"))
                .select("src", "source_size", "goal", "blocks", "rest", "slots", "lo", "hi", "n"), "mix-sources")
    first = src.select("n").first()
    n = first[0] if first and first[0] else 0
    cells = src.where("slots > 0").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1).cast("long")))))
    points = (spark.range(n).select(F.col("id").alias("slot"), ((F.col("id") + 1) * F.lit(GOLDEN) % F.lit(1.0)).alias("p"))
              .withColumn("cell", F.floor(F.col("p") * CELLS)))
    drawn = points.join(cells.select("cell", "src", "lo", "hi"), "cell").where("p >= lo and p < hi").select(
        "slot", "src", F.expr(f"slot div {BUCKET_ROWS}").alias("bucket"))
    drawn = _before(drawn, ["src"], "bucket", ["slot"], F.lit(1), "rank").select("slot", "src", "rank")
    drawn = drawn.join(src.select("src", "slots"), "src").where("rank < slots").drop("slots")
    counts = drawn.groupBy("src").agg(F.count("*").alias("k"))
    left = src.join(counts, "src", "left").select("src", "slots", F.coalesce("k", F.lit(0)).alias("k")).where("k < slots")
    left = left.select("src", F.explode(F.sequence("k", F.col("slots") - 1)).alias("rank")).select(
        (F.lit(n) + F.col("rank")).alias("slot"), "src", "rank")
    row = F.col("rank") % F.col("blocks")
    own = F.least(F.lit(block), F.col("source_size") - row * block)
    last = F.when((F.col("rank") == F.col("slots") - 1) & (F.col("rest") % block != 0), F.least(F.col("rest") % block, own)
                  ).otherwise(own)
    return drawn.unionByName(left).join(src, "src").select(
        "slot", "src", "rank", row.alias("block"), last.cast("long").alias("words"))


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, limit: float = 2.0,
        block: int = BLOCK) -> DataFrame:
    """(doc_id, tk, source, size, source_size, target, taken) per row: how many words the mix takes of it, repeats counted."""
    sizes = store(docs.select("doc_id", "source", _key().alias("tk"), n_words(F.col("text")).alias("size")),
                  "mix-sizes")
    goals = store(targets(sizes, weights, share, limit), "mix-targets")
    keyed = sizes.join(F.broadcast(goals) if goals.count() <= 10_000 else goals, sizes["source"].eqNullSafe(
        goals["source"])).drop(goals["source"])
    mixed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = keyed.withColumn("h", mixed).withColumn(
        "bucket", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
                          * F.ceil(F.col("n_docs") / F.lit(BUCKET_ROWS))))
    order = ["h", F.asc_nulls_first("doc_id"), "size", "tk"]
    placed = store(_before(keyed, ["src"], "bucket", order, F.col("size"), "start").drop("h", "bucket", "n_docs")
                   .withColumn("row", F.monotonically_increasing_id()), "mix-places")
    held = placed.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    begin, end = F.greatest(F.col("start") - F.col("block") * block, F.lit(0)), F.least(
        F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    held = held.select("row", "src", "block", begin.alias("x"), end.alias("y"))
    slots = schedule(goals, block).select("src", "block", "words")
    takes = (held.join(shuffled(slots), ["src", "block"])
             .select("row", F.greatest(F.least("y", "words") - F.col("x"), F.lit(0)).alias("t"))
             .groupBy("row").agg(F.sum("t").alias("taken")))
    return placed.join(takes, "row", "left").select(
        "doc_id", "tk", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: whole texts once or twice, and of a text that the
    mix ends in, the first words (joined by single spaces) as a further row. n_chars, if there, follows the text."""
    takes = (mix(docs, **options).groupBy("tk").agg(F.max("size").alias("__size"), F.sum("taken").alias("__taken"))
             .where("__taken > 0"))
    keyed = docs.withColumn("__tk", _key())
    one = Window.partitionBy("__tk").orderBy("__tk")  # rows repeating everything were summed: one stands for all
    held = keyed.join(takes.withColumnRenamed("tk", "__tk"), "__tk").withColumn("__n", F.row_number().over(one)).where("__n = 1")
    rest = F.expr("__taken % __size")
    parts = F.concat(F.array_repeat("__size", F.expr("cast(__taken div __size as int)")),
                     F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    words = F.slice(F.array_remove(F.split("text", SPACES), ""), F.lit(1), F.col("__part").cast("int"))
    out = held.withColumn("__part", F.explode(parts)).withColumn(
        "text", F.when(F.col("__part") == F.col("__size"), F.col("text")).otherwise(F.array_join(words, " ")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
