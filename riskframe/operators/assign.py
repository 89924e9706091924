"""Assignment joins: weighted (inverse CDF), nearest key, first-matching rule, uniform pick.

All draws come from :mod:`riskframe.functions.seeded`, so an assignment depends only on
(salt, row key). Range and nearest lookups go through the trees of :mod:`riskframe.operators.fences`: one path for
dimensions of any size, never a scan of the dimension per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from riskframe.operators import fences
from riskframe.plans.sizing import broadcast_if_small
from riskframe.session import stored
from riskframe.sources.dims import LEFTOVER_PROFILE


def cdf_dim(weights: DataFrame, key: str, weight: str) -> DataFrame:
    """(key, weight, other columns, lo, hi): cumulative shares in key order; first lo = 0, last hi forced to 1.

    Sums are exact whatever the number of keys and however they are cut: integer weights as they are, others as DECIMAL
    parts of the largest weight (27 digits after the point, finer than the rounding of a double sum). So ``lo`` of a
    row is ``hi`` of the row before, bit for bit. Rows with a null key or weight take no part; weights may be zero
    (an empty interval) but not negative; with no positive weight the shares are null.
    """
    cols = [c for c in weights.columns if c not in (key, weight)]
    rows = weights.where(F.col(key).isNotNull() & F.col(weight).isNotNull())
    if isinstance(weights.schema[weight].dataType, IntegralType):
        rows = rows.withColumn("_w", F.col(weight).cast("decimal(38,0)"))
    else:
        largest = rows.agg(F.max(weight).cast("double").alias("_wmax"))  # one row
        part = F.col(weight).cast("double") / F.nullif(F.col("_wmax"), F.lit(0.0))
        rows = rows.crossJoin(F.broadcast(largest)).withColumn("_w", part.cast("decimal(28,27)")).drop("_wmax")
    totals = rows.agg(F.nullif(F.sum("_w").cast("double"), F.lit(0.0)).alias("_tot"), F.max(key).alias("_kmax"))  # one row
    j = fences.running_totals(rows, key, ["_w"]).crossJoin(F.broadcast(totals))
    upto = fences.plus(F.col("_w_before"), F.col("_w"), j.schema["_w_before"].dataType)
    hi = F.when(F.col(key) == F.col("_kmax"), F.lit(1.0)).otherwise(upto.cast("double") / F.col("_tot"))
    return j.select(key, weight, *cols, (F.col("_w_before").cast("double") / F.col("_tot")).alias("lo"), hi.alias("hi"))


def range_lookup(df: DataFrame, u: Column | str, dim: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Left join each row to the dim row with ``lo < u <= hi``, for intervals that do not overlap.

    The dimension is written once; Spark broadcasts it if its files are small. The row's interval is the one with the largest
    ``lo`` below ``u``, found by :func:`fences.locate`, then an equi-join on that ``lo`` checks ``hi``. A null draw, or
    one in a gap, gets nulls.
    """
    dim = stored(dim.where(F.col(lo) < F.col(hi)).withColumnRenamed(lo, "_lo").withColumnRenamed(hi, "_hi"), "intervals")
    left = df.withColumn("_u", (F.col(u) if isinstance(u, str) else u).cast("double"))
    left = fences.locate(left, "_u", dim.select(F.col("_lo").cast("double")).distinct(), "_lo", "_at")
    out = left.join(dim, (F.col("_at") == F.col("_lo")) & (F.col("_u") <= F.col("_hi")), "left")
    return out.drop("_lo", "_hi", "_u", "_at")


def nearest_dim(keys: DataFrame, key: str) -> DataFrame:
    """Intervals (lo, hi] of the unit interval in which ``key`` is the nearest key.

    Boundaries are midpoints of neighbouring keys; a draw exactly on a midpoint belongs to
    the lower key, the ends clamp to the first / last key. Keys are distinct and not null.
    """
    near = fences.neighbours(keys, key)
    prev_k, next_k = F.col("prev_key"), F.col("next_key")
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    return near.select(
        *keys.columns,
        F.when(prev_k.isNull(), F.lit(0.0)).otherwise(clamp((prev_k + F.col(key)) / 2.0)).alias("lo"),
        F.when(next_k.isNull(), F.lit(1.0)).otherwise(clamp((F.col(key) + next_k) / 2.0)).alias("hi"),
    )


def first_matching_rule(customers: DataFrame, rules: DataFrame, gender: str = "gender", age: str = "age",
                        city_pop: str = "city_pop", default: str = LEFTOVER_PROFILE) -> DataFrame:
    """Adds ``profile`` (first rule in priority order that matches, else ``default``) and
    ``n_matches`` (how many rules match; > 1 is an overlap).

    The rules (a configuration-sized list) are folded into one sorted array in a one-row frame
    and broadcast; matching is a ``filter`` over that array per customer, so customers are
    neither shuffled nor multiplied by the number of rules.
    """
    rule_arr = rules.agg(
        F.array_sort(F.collect_list(F.struct("prio", "profile", "genders", "age_min", "age_max", "pop_min", "pop_max")))
        .alias("_rules")
    )
    g, a, p = F.col(gender), F.col(age).cast("double"), F.col(city_pop).cast("double")

    def matches(r):
        return (
            F.array_contains(r["genders"], g)
            & (a >= r["age_min"]) & (r["age_max"].isNull() | (a < r["age_max"]))
            & (p >= r["pop_min"]) & (r["pop_max"].isNull() | (p < r["pop_max"]))
        )

    hits = F.filter(F.col("_rules"), matches)
    return (
        customers.crossJoin(F.broadcast(rule_arr))
        .withColumn("_hits", hits)
        .withColumn("profile", F.coalesce(F.get(F.col("_hits"), 0)["profile"], F.lit(default)))
        .withColumn("n_matches", F.size("_hits").cast("bigint"))
        .drop("_rules", "_hits")
    )


def index_within_group(items: DataFrame, group: str, item: str, buckets: int = 256) -> DataFrame:
    """(group, item, idx, group_size) with idx a bijection onto 1..group_size.

    A hot group is never ranked in one task: items are spread over ``buckets`` hash buckets,
    each (group, bucket) is ranked by item on its own, and bucket offsets come from a prefix
    sum over the small (group, bucket) count table.
    """
    from riskframe.functions.seeded import h

    b = items.select(group, item).dropDuplicates().withColumn("_bk", h("bucket", F.col(item)) % buckets)
    counts = b.groupBy(group, "_bk").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.partitionBy(group).orderBy("_bk")
    offsets = counts.select(
        group, "_bk",
        (F.sum("_c").over(wo) - F.col("_c")).alias("_off"),
        F.sum("_c").over(Window.partitionBy(group)).alias("group_size"),
    )
    local = b.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_bk").orderBy(item)))
    return local.join(broadcast_if_small(offsets, 1_000_000), [group, "_bk"]).select(
        group, item, (F.col("_off") + F.col("_r")).cast("bigint").alias("idx"), "group_size"
    )


def pick_uniform(df: DataFrame, group: str, u: Column, pool: DataFrame, pool_group: str, pool_item: str,
                 out: str = "picked", buckets: int = 256) -> DataFrame:
    """For each row pick item number ``1 + floor(u * size)`` of its group's pool (uniform)."""
    idx = index_within_group(pool, pool_group, pool_item, buckets)
    sizes = idx.select(pool_group, "group_size").dropDuplicates()
    with_size = df.join(broadcast_if_small(sizes, 1_000_000), F.col(group) == F.col(pool_group), "left").drop(pool_group)
    pick = with_size.withColumn("_idx", (F.lit(1) + F.floor(u * F.col("group_size"))).cast("bigint"))
    pick = pick.withColumn("_idx", F.least(F.col("_idx"), F.col("group_size")))
    idx_r = idx.select(F.col(pool_group).alias("_pg"), F.col("idx").alias("_pi"), F.col(pool_item).alias(out))
    joined = pick.join(idx_r, (F.col(group) == F.col("_pg")) & (F.col("_idx") == F.col("_pi")), "left")
    return joined.drop("_pg", "_pi", "_idx", "group_size")
