"""Stream scoring gives the same predictions as batch scoring with the same saved model."""

from pyspark.ml import PipelineModel

from conftest import SF_SMALL
from riskframe.plans import detector
from riskframe.session import scratch_path
from riskframe.sources.tables import txn
from riskframe.streaming.scoring import scored_stream


def test_stream_matches_batch(spark):
    cfg = detector.DetectorConfig(num_trees=[5], max_depth=[3], n_components=6)
    t = txn(spark, SF_SMALL)
    frame = detector.model_frame(t, cfg)
    prep = detector.preprocessing(cfg).fit(frame)
    rf = detector.forest(cfg, 5, 3).fit(prep.transform(frame))
    model = PipelineModel(stages=[*prep.stages, rf])
    mpath, src = scratch_path(spark, "m"), scratch_path(spark, "src")
    model.write().overwrite().save(mpath)
    t.write.parquet(src)
    q = (scored_stream(spark, src, t.schema, mpath, cfg).writeStream.format("memory").queryName("scored_stream_t")
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    streamed = {r.event_id: r.fraud_probability for r in spark.table("scored_stream_t").collect()}
    batch = {r.event_id: r.fraud_probability for r in detector.score_columns(model.transform(frame), cfg).collect()}
    assert streamed == batch and len(batch) == t.count()
