"""Reject routing: rows that fail a check go to a reject table with the reasons, the others to the good one, in one pass.

Both tables are the two values of one partition column of a single write, so the input is computed once, a row is in
exactly one of them, and a batch and a stream (file sink, exactly once) write the same layout. The reasons are all the
checks that a row fails, in the order given; a check that gives null counts as passed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Checks = Sequence[tuple[str, Column]]


def checked(df: DataFrame, checks: Checks) -> DataFrame:
    """``df`` with ``reasons``, the names of the failed checks, and ``rejected``, 1 if there is any."""
    reasons = F.array_compact(F.array(*[F.when(fails, F.lit(name)) for name, fails in checks]))
    return df.withColumn("reasons", reasons).withColumn("rejected", (F.size("reasons") > 0).cast("int"))


def write_routed(df: DataFrame, checks: Checks, path: str) -> dict[str, int]:
    """Writes both tables below ``path`` and returns the rows written and rejected, counted in the written files."""
    checked(df, checks).write.mode("overwrite").partitionBy("rejected").parquet(path)
    n = {r["rejected"]: r["count"] for r in df.sparkSession.read.schema("rejected int").parquet(path).groupBy("rejected").count().collect()}
    return {"rows": sum(n.values()), "rejected": n.get(1, 0)}


def start_routed(stream: DataFrame, checks: Checks, path: str, checkpoint: str) -> StreamingQuery:
    """The same for a stream, over what has arrived; a restarted query goes on without loss or repeats."""
    return (checked(stream, checks).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("rejected").outputMode("append").trigger(availableNow=True).start())


def read_good(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("rejected = 0").drop("reasons", "rejected")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("rejected = 1").drop("rejected")
