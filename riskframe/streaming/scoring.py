"""Stream scoring: the detector's stateless steps applied to newly arriving transaction files.

The reference has no streaming code. Nothing new is computed here: the same feature
projection and a fitted, saved ``PipelineModel`` (see :mod:`riskframe.plans.detector`) are
applied to a Parquet file stream, so transactions landing in a folder are scored as they
arrive. The job is stateless (no aggregation state); each micro-batch is appended to the sink
with exactly-once file-sink semantics guarded by the checkpoint location.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.plans import detector
from riskframe.sources import rejects


def scored_stream(spark: SparkSession, source_dir: str, schema, model_path: str,
                  cfg: detector.DetectorConfig | None = None, max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming DataFrame of (key, label, prediction, fraud_probability, reasons, rejected) for txn-shaped files.

    A row that lacks numeric features is not scored: its prediction and probability are null, ``reasons`` names what it
    lacks and ``rejected`` is 1. Every arriving row is in the output, from one pass."""
    cfg = cfg or detector.DetectorConfig()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    frame = rejects.checked(detector.model_frame(stream, cfg), detector.feature_checks())
    whole = frame.withColumns({c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in detector.NUMERIC})
    pred = PipelineModel.load(model_path).transform(whole)
    scored = F.col("rejected") == 0
    p1 = F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0))
    return pred.select(cfg.key, cfg.label, F.when(scored, F.col("prediction")).alias("prediction"),
                       F.when(scored, p1).alias("fraud_probability"), "reasons", "rejected")


def start_scoring(spark: SparkSession, source_dir: str, schema, model_path: str, sink_dir: str,
                  checkpoint_dir: str, cfg: detector.DetectorConfig | None = None) -> StreamingQuery:
    """Append scored rows and rejects as Parquet to ``sink_dir``, by ``rejected`` (see :func:`rejects.read_good` and
    :func:`rejects.read_rejects`); progress is kept in ``checkpoint_dir`` (a shared folder), so a restarted query
    resumes without rescoring or losing files."""
    out = scored_stream(spark, source_dir, schema, model_path, cfg)
    return (out.writeStream.format("parquet").option("path", sink_dir).partitionBy("rejected")
            .option("checkpointLocation", checkpoint_dir).outputMode("append").start())
