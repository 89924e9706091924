"""Quantiles without sorting or gathering the column: exact by range narrowing, approximate with measured rank error.

``percentile_disc`` keeps every distinct value of a group in one aggregation buffer, which
for a global median means one task holds the whole value set. Here a mergeable quantile sketch (``percentile_approx``:
partial sketches per task, merged) first brackets the wanted rank; each further pass is a partial/final aggregate of at most
``buckets`` + 2 rows (count, min, max per equal-width bucket of the current range), the driver reads those few
rows and keeps the bucket that holds the rank. The passes read the input itself, nothing is kept beside it; from the second
one on the range is a filter that reaches a Parquet scan. The loop ends when a bucket holds a single value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: 1 / relative rank error of the sketches.
ACCURACY = 10_000


def exact_quantile(df: DataFrame, col: str, p: float, buckets: int = 4096, max_passes: int = 64) -> float | int | None:
    """Smallest value v with cume_dist(v) >= p (SQL ``percentile_disc``); NULLs ignored."""
    whole = isinstance(df.schema[col].dataType, IntegralType)
    vals = df.select(F.col(col).cast("bigint" if whole else "double").alias("_v")).where(F.col("_v").isNotNull())
    near = [max(0.0, p - 2 / ACCURACY), min(1.0, p + 2 / ACCURACY)]
    n, least, most, bracket = vals.agg(F.count(F.lit(1)), F.min("_v"), F.max("_v"), F.percentile_approx("_v", near, ACCURACY)).first()
    if n == 0:
        return None
    rank = max(1, math.ceil(p * n))  # 1-based rank wanted
    lo, hi = bracket
    below = None  # rows below the current range; not known of the sketch's bracket
    for _ in range(max_passes):
        if below is not None and lo == hi:
            return lo
        width = (hi - lo) / buckets
        above = (F.col("_v").cast("decimal(20,0)") - F.lit(Decimal(lo))).cast("double") if whole else F.col("_v") - F.lit(lo)
        inside = F.least(F.floor(above / F.lit(width)), F.lit(buckets - 1)) if width else F.lit(0).cast("bigint")
        b = F.when(F.col("_v") < F.lit(lo), F.lit(-1)).when(F.col("_v") > F.lit(hi), F.lit(buckets)).otherwise(inside)
        read = vals if below is None else vals.where((F.col("_v") >= F.lit(lo)) & (F.col("_v") <= F.lit(hi)))
        rows = (
            read.groupBy(b.alias("b"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("mn"), F.max("_v").alias("mx"))
            .orderBy("b")
            .collect()
        )  # at most `buckets` + 2 rows
        below = below or 0
        for r in rows:
            if below + r["c"] >= rank:
                # outside of the bracket as well: those buckets hold all that is below or above it
                lo, hi = r["mn"], r["mx"]
                break
            below += r["c"]
    raise RuntimeError("exact_quantile did not converge")


def sketched_quantiles(df: DataFrame, groups: Sequence[str], col: str, ps: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """(groups..., p, value, n, rank_low, rank_high, rank_error): approximate quantiles per group, and how far off they are.

    One mergeable sketch per group gives the values. A second aggregate counts, per group and value, the rows below
    it and up to it; ``rank_error`` is the distance from ``p * n`` to that range of ranks, as a share of n (0 if it is met).
    Null values are ignored; a group without other values gives no rows."""
    vals = df.where(F.col(col).isNotNull())
    named = F.arrays_zip(F.array(*[F.lit(float(p)) for p in ps]).alias("p"), F.percentile_approx(col, list(ps), accuracy).alias("value"))
    found = vals.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), named.alias("_q"))
    # a row of the group's values beside each of its rows: counted in partial aggregates, not exploded
    per = vals.join(found.select(*groups, F.col("_q.value").alias("_values")), list(groups)) if groups else \
        vals.crossJoin(F.broadcast(found.select(F.col("_q.value").alias("_values"))))
    counts = [F.sum((F.col(col) < F.get("_values", F.lit(i))).cast("bigint")).alias(f"_lo{i}") for i in range(len(ps))]
    counts += [F.sum((F.col(col) <= F.get("_values", F.lit(i))).cast("bigint")).alias(f"_hi{i}") for i in range(len(ps))]
    ranks = per.groupBy(*groups).agg(*counts)
    ends = F.array(*[F.struct(F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi")) for i in range(len(ps))])
    both = found.join(ranks, list(groups)) if groups else found.crossJoin(F.broadcast(ranks))
    rows = both.select(*groups, "n", F.explode(F.arrays_zip("_q", ends.alias("ends"))).alias("x"))
    wanted = F.greatest(F.ceil(F.col("p") * F.col("n")), F.lit(1))
    off = F.greatest(F.col("rank_low") + 1 - wanted, wanted - F.col("rank_high"), F.lit(0)).cast("double")
    rows = rows.select(*groups, F.col("x._q.p").alias("p"), F.col("x._q.value").alias("value"), "n",
                       F.col("x.ends.lo").alias("rank_low"), F.col("x.ends.hi").alias("rank_high"))
    return rows.withColumn("rank_error", off / F.col("n"))
