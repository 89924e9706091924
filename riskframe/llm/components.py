"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import BROADCAST_ROWS, shuffled, store


def _smallest(edges: DataFrame, key: str, other: str, few: bool) -> DataFrame:
    """Each edge with the smallest of its key's partners and the key itself (partial aggregation, then a join; ``few``
    keys are broadcast)."""
    least = edges.groupBy(key).agg(F.min(other).alias("m"))
    return edges.join(F.broadcast(least) if few else shuffled(least), key).withColumn("m", F.least("m", key))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Only edges are held; each round is written to the shared folder, which cuts its lineage. Ends
    when a round changes nothing (rounds grow with the logarithm of the longest chain) and raises
    if that takes more than ``max_rounds``. No edges: no rows. Repeated edges and loops are allowed.
    """
    cur = store(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = state(cur)
    if before[0] == 0:
        return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        few = 2 * before[0] <= BROADCAST_ROWS  # a round makes at most two rows of an edge
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_smallest(both, "u", "v", few).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        low = _smallest(large, "u", "v", few)
        small = (low.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        cur = store(small, "edges")
        after = state(cur)
        if after == before:
            roots = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
