"""Statistics and summaries: histogram, label counts, fraud rate, quantiles, moments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.numeric import round_half_up


def equal_width_histogram(df: DataFrame, col: str = "amt", bins: int = 20, closed: bool = False) -> DataFrame:
    """``bins`` equal-width bins over [min, max] of ``col`` with counts and percentages.

    One global aggregate (exactly one row, so its broadcast is bounded) is joined to every
    row; the per-bin aggregate is partial/final (map-side combine); the share-of-total window
    runs over at most ``bins + 1`` rows after aggregation. NULLs are excluded.
    When min = max every value falls in bin 0 (the width-0 division is guarded). With
    ``closed=False`` the maximum opens an extra bin ``bins`` as plain SQL does; ``closed=True``
    folds it into the last bin.
    """
    vals = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull())
    stats = vals.agg(F.min("_v").alias("_min"), F.max("_v").alias("_max")).select(
        "_min", ((F.col("_max") - F.col("_min")) / F.lit(float(bins))).alias("_w")
    )
    raw_bin = F.when(F.col("_w") == 0, F.lit(0)).otherwise(F.floor((F.col("_v") - F.col("_min")) / F.col("_w")))
    if closed:
        raw_bin = F.least(raw_bin, F.lit(bins - 1))
    binned = vals.crossJoin(F.broadcast(stats)).select(
        raw_bin.cast("bigint").alias("bin_id"),
        (F.col("_min") + raw_bin.cast("double") * F.col("_w")).alias("_start"),
        F.col("_w"),
    )
    per_bin = binned.groupBy("bin_id", "_start", "_w").agg(F.count(F.lit(1)).alias("frequency"))
    total = F.sum("frequency").over(Window.partitionBy())
    return per_bin.select(
        "bin_id",
        round_half_up(F.col("_start"), 2).alias("range_start"),
        round_half_up(F.col("_start") + F.col("_w"), 2).alias("range_end"),
        "frequency",
        round_half_up(F.lit(100.0) * F.col("frequency").cast("double") / total.cast("double"), 2).alias("percentage"),
    ).orderBy("bin_id")


def fraud_rate(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Total rows, fraud rows, clean rows and the fraud share in one pass (NULL share when empty)."""
    y = F.col(label)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.when(y == 1, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("fraud"),
        F.coalesce(F.sum(F.when(y == 0, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("clean"),
    ).select(
        "total", "fraud", "clean",
        F.try_divide(F.col("fraud").cast("double"), F.col("total").cast("double")).alias("fraud_rate"),
    )


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k_counts(df: DataFrame, key: str, k: int = 10, name: str = "n") -> DataFrame:
    """Counts per key, largest first, ties broken by key; the ``k`` limit is the feature (top-k)."""
    return count_by(df, key, name=name).orderBy(F.col(name).desc(), F.col(key).asc()).limit(k)


def amount_band(col: Column | str) -> Column:
    """<50 low, <200 medium, <500 high, else (including NULL) very_high."""
    c = F.col(col) if isinstance(col, str) else col
    return (
        F.when(c < 50, "low").when(c < 200, "medium").when(c < 500, "high").otherwise("very_high")
    )
