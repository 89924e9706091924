"""Session helpers: a local session for tests/bench and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskframe") -> SparkSession:
    """Local session used by tests and the bench. On a cluster, build the session yourself."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master  # "local-cluster" has workers of its own and is none
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present. Only a local session with no setting
    gets a fresh folder under the system temp directory (tests, bench).
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder for this cluster")
    local_dir = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    spark.sparkContext.setCheckpointDir(local_dir)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written intermediate tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: its lineage is cut, a lost
    executor re-reads files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, max_bytes: int = 8 << 20) -> None:
    """Arrow batches to Python workers hold at most about ``max_bytes`` (a session setting, lowered if it allows more)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > max_bytes:
        spark.conf.set(name, str(max_bytes))


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
