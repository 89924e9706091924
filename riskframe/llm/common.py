"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from riskframe.session import scratch_path

#: A stored table of at most this many rows may be broadcast (rows here are a few longs wide).
BROADCAST_ROWS = 200_000

#: Arrow batches to Python workers hold at most about this many bytes (set in the session if it allows more).
BATCH_BYTES = 8 << 20

#: Spark's setting that a query's shuffle files go when it ends (on while a table is stored).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared checkpoint folder and read it back.

    The shuffle files behind the table are of no use once it is written; Spark is told to remove them then.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_stored(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the stored table's counted rows are within the bound, else none of either side."""
    return F.broadcast(stored) if stored.count() <= max_rows else shuffled(stored)


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that Spark must not broadcast by its own estimate: that knows neither the rows an explode makes nor
    how well the files of a stored table are compressed. The join is sorted and merged (a hint; other joins stay as they are)."""
    return df.hint("merge")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key of a row's id and text; rows share it only if they repeat both."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("\x00null")), F.col(text_col))


def bounded_batches(spark: SparkSession) -> None:
    conf = spark.conf
    if int(conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) > BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[tuple]], schema: str, chunk: int = 4096) -> DataFrame:
    """mapInArrow over row dictionaries: ``fn`` takes an iterator of rows and yields output tuples.

    Rows are converted 64 at a time and written out every ``chunk`` results or 16 MB, so memory
    does not grow with the partition.
    """
    bounded_batches(df.sparkSession)
    out = StructType.fromDDL(schema)
    names = out.names
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    yield from batch.slice(at, 64).to_pylist()

        held: list[tuple] = []
        size = 0
        for row in fn(rows()):
            held.append(row)
            size += 16 + sum(len(v) for v in row if isinstance(v, (str, bytes, list)))
            if len(held) >= chunk or size >= 16 << 20:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=arrow.field(n).type) for c, n in zip(zip(*held), names)], schema=arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=arrow.field(n).type) for c, n in zip(zip(*held), names)], schema=arrow)

    return df.mapInArrow(run, out)
