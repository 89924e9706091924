"""Reject routing in batch and stream, globs of several schemas, inferred CSV, config and lookup files, balanced writes, gamma draws."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from riskframe.operators import sampling
from riskframe.plans import detector, q_files
from riskframe.session import scratch_path
from riskframe.sources import configs, dims, files, rejects
from riskframe.sources.tables import txn
from riskframe.streaming.scoring import start_scoring


def test_batch_and_stream_give_the_same_two_tables(spark, tmp_path):
    raw = q_files.raw_records(spark, SF_SMALL)
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    counts = rejects.write_routed(raw, q_files.record_checks(), batch)
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # a restart finds nothing new
        source = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
        rejects.start_routed(source, q_files.record_checks(), stream, str(tmp_path / "progress")).awaitTermination()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(rejects.read_good(spark, batch)) == rows(rejects.read_good(spark, stream))
    assert rows(rejects.read_rejects(spark, batch)) == rows(rejects.read_rejects(spark, stream))
    bad = rejects.read_rejects(spark, batch)
    assert counts == {"rows": raw.count(), "rejected": bad.count()} and 0 < counts["rejected"] < counts["rows"]
    whole = bad.drop("reasons").unionByName(rejects.read_good(spark, batch))
    assert rows(whole.select(raw.columns)) == rows(raw)


def test_all_reasons_are_kept_and_null_checks_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, "2023-02-30", "25:00:00", "abc"), (2, "2023-02-01", "10:00:00", "-1"), (3, "2023-02-01", "10:00:00", "1")],
                               "rec_id int, d string, t string, a string")
    rejects.write_routed(df, q_files.record_checks(), str(tmp_path / "r"))
    assert {r.rec_id: r.reasons for r in rejects.read_rejects(spark, str(tmp_path / "r")).collect()} == {
        1: ["bad_date", "bad_time", "bad_amount"], 2: ["negative_amount"]}
    counts = rejects.write_routed(df.limit(0), q_files.record_checks(), str(tmp_path / "none"))
    assert counts == {"rows": 0, "rejected": 0}


def test_stream_scoring_keeps_rows_without_features(spark, tmp_path):
    cfg = detector.DetectorConfig(num_trees=[3], max_depth=[3], n_components=6)
    t = txn(spark, SF_SMALL)
    frame = detector.model_frame(t, cfg)
    prep = detector.preprocessing(cfg).fit(frame)
    model = PipelineModel(stages=[*prep.stages, detector.forest(cfg).fit(prep.transform(frame))])
    model.write().overwrite().save(str(tmp_path / "model"))
    arriving = q_files._lacking(t)
    arriving.write.parquet(str(tmp_path / "in"))
    query = start_scoring(spark, str(tmp_path / "in"), arriving.schema, str(tmp_path / "model"), str(tmp_path / "out"), str(tmp_path / "ck"), cfg)
    query.processAllAvailable()
    query.stop()
    out = str(tmp_path / "out")
    bad = {r.event_id: r.reasons for r in rejects.read_rejects(spark, out).collect()}
    expected = {r.event_id: r.missing for r in detector.rejected(detector.model_frame(arriving, cfg), cfg).collect()}
    assert bad == expected and len(bad) > 5
    good = {r.event_id: r.fraud_probability for r in rejects.read_good(spark, out).collect()}
    whole = detector.model_frame(arriving, cfg).where(detector.has_features())
    assert good == {r.event_id: r.fraud_probability for r in detector.score_columns(model.transform(whole), cfg).collect()}
    assert len(good) + len(bad) == t.count()


def test_globs_unite_and_widen(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(1, 2.5, "x", 7)], "id int, v float, a string, code int").write.parquet(f"{base}/gen=1/part=1")
    spark.createDataFrame([(2, 3.5, "y")], "id int, v float, c string").write.parquet(f"{base}/gen=1/part=2")
    spark.createDataFrame([(2**40, 0.1, "z", "q7")], "id bigint, v double, b string, code string").write.parquet(f"{base}/gen=2/part=1")
    spark.createDataFrame([(9, 9.0)], "id bigint, v double").write.parquet(f"{base}/gen=2/other=3")
    back = files.read_globs(spark, [f"{base}/gen=1/part=*", f"{base}/gen=2/part=*"], base)
    types = dict(back.dtypes)
    assert types["id"] == "bigint" and types["v"] == "double" and types["code"] == "string"
    got = {r.id: r for r in back.collect()}
    assert set(got) == {1, 2, 2**40} and got[1].code == "7" and got[2].c == "y" and got[2**40].v == 0.1 and got[2**40].gen == 2
    assert got[1].b is None and got[2**40].a is None


@pytest.mark.parametrize("a, b, both", [("tinyint", "bigint", "bigint"), ("int", "float", "double"), ("float", "double", "double"),
                                        ("date", "timestamp", "timestamp"), ("int", "string", "string"), ("boolean", "int", "string"),
                                        ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)")])
def test_widened_types(spark, a, b, both):
    x, y = (spark.createDataFrame([], f"c {t}").schema[0].dataType for t in (a, b))
    assert files.widened(x, y).simpleString() == files.widened(y, x).simpleString() == both


def test_lines_that_do_not_fit_the_inferred_types_are_kept(spark, tmp_path):
    path = str(tmp_path / "csv")
    lines = ["id|v|name"] + [f"{i}|{i / 4}|n{i}" for i in range(2_000)] + ["x7|1.0|late"]
    (tmp_path / "csv").write_text("\n".join(lines) + "\n")
    df = files.read_inferred(spark, path, sep="|", sampling_ratio=0.05).cache()
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "string", "string"] or df.where("id = 'x7'").count() == 1
    assert df.count() == 2_001
    if dict(df.dtypes)["id"] == "int":
        assert [r._corrupt_record for r in df.where("_corrupt_record is not null").collect()] == ["x7|1.0|late"]


def test_config_files_equal_the_built_in_dims(spark, tmp_path):
    import json

    (tmp_path / "main_config.json").write_text(json.dumps(
        {**dims.DEFAULT_SEGMENT_RULES, "leftovers.json": {"gender": ["F"], "age": {"min": 0, "max": -1}, "city_pop": {"min": 0, "max": -1}}}, indent=2))
    got = [tuple(r) for r in configs.read_segment_rules(spark, str(tmp_path / "main_config.json")).orderBy("prio").collect()]
    assert got == [tuple(r) for r in dims.segment_rules(spark).orderBy("prio").collect()]
    folder = tmp_path / "settings"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(dims.DEFAULT_PROFILE_SETTINGS, indent=4))
    (folder / "b.json").write_text('{"cut": {"avg_transactions_per_day": {"min": 1,')
    got = sorted(tuple(r) for r in configs.read_profile_settings(spark, str(folder)).collect())
    assert got == sorted(tuple(r) for r in dims.profile_settings(spark).collect())
    bad = configs.json_documents(spark, str(folder), configs.SETTINGS).where("_corrupt_record is not null").collect()
    assert [r.file for r in bad] == ["b.json"] and bad[0]._corrupt_record.startswith('{"cut"')


def test_lookup_files(spark, tmp_path):
    (tmp_path / "ag.csv").write_text("group,age,gender,share\nx,30,F,0.25\ny,20,M,0.5\n\nz,40,F,0.25\n")
    rows = configs.read_age_gender(spark, str(tmp_path / "ag.csv")).orderBy("line_no").collect()
    assert [(r.gender, r.age, r.lo, r.hi) for r in rows] == [("F", 30.0, 0.0, 0.25), ("M", 20.0, 0.25, 0.75), ("F", 40.0, 0.75, 1.0)]
    (tmp_path / "m.csv").write_text("category|merchant_name\na|one\na|two, three\nb|four\n")
    assert sorted(tuple(r) for r in configs.read_merchants(spark, str(tmp_path / "m.csv")).collect()) == [
        ("a", "one"), ("a", "two, three"), ("b", "four")]


def test_a_hot_partition_is_written_by_tasks_that_follow_its_size(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    hot = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") % 50 > 0, 1).otherwise(
        F.col("id") % 7).alias("p"))
    try:
        found = []
        for size in ("64m", "1m"):
            spark.conf.set(name, size)
            path = tmp_path / size
            files.write_partitioned(hot, str(path), ["p"], max_records_per_file=0)
            found.append(len(list((path / "p=1").glob("part-*"))))
            assert size == "1m" or all(len(list((path / f"p={p}").glob("part-*"))) == 1 for p in (0, 2, 3))
            assert files.read_partitioned(spark, str(path)).count() == 200_000
    finally:
        spark.conf.set(name, before)
    assert found[0] == 1 and found[1] >= 5


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    files.write_partitioned(spark.range(100).select("id", (F.col("id") % 12).alias("month")), str(tmp_path / "t"), ["month"])
    plan = files.read_partitioned(spark, str(tmp_path / "t")).where("month = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


@pytest.mark.parametrize("shape", [0.3, 1.0, 5.0])
def test_gamma_draws_have_the_gamma_distribution(spark, shape):
    n, scale = 40_000, 2.0
    draws = spark.range(n).select(sampling.gamma_draw(F.lit(shape), F.lit(scale), "id", "t").alias("x"))
    x = np.sort(np.array([r.x for r in draws.collect()]))
    assert (x > 0).all()
    assert abs(x.mean() - shape * scale) < 4 * math.sqrt(shape * scale**2 / n)
    spread = math.sqrt((6 / shape + 2) / n)  # of the variance, relative
    assert abs(x.var() / (shape * scale**2) - 1) < 5 * spread
    # Kolmogorov and Smirnov against the distribution function, by numeric integration in log x
    grid = np.exp(np.linspace(math.log(1e-14), math.log(200), 400_000))
    dens = np.exp(shape * np.log(grid) - grid / scale - math.lgamma(shape) - shape * math.log(scale))
    cdf = np.concatenate([[0], np.cumsum((dens[1:] + dens[:-1]) / 2 * np.diff(np.log(grid)))])
    at = np.interp(x, grid, cdf)
    assert np.abs(at - (np.arange(n) + 0.5) / n).max() < 1.95 / math.sqrt(n)
    again = spark.range(n).repartition(3).select(sampling.gamma_draw(F.lit(shape), F.lit(scale), "id", "t").alias("x"))
    assert np.array_equal(x, np.sort(np.array([r.x for r in again.collect()])))


def test_rejects_of_a_larger_table(spark):
    out = q_files.feature_rejects(spark, SF_CHECK)
    assert out.where(F.col("missing").contains("zip_numeric")).count() > 20
