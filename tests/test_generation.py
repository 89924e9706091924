"""Generation job invariants: fraud rows inside the fraud window, no clean row on a fraud date,
same rows under a different partitioning, summary consistent with the rows."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskframe.plans import generation


def test_generated_rows_respect_fraud_windows(spark):
    g = generation.generate(spark, SF_SMALL).cache()
    assert g.count() > 0
    fraud = g.where("is_fraud = 1").select("customer_id", "trans_date").dropDuplicates()
    clean = g.where("is_fraud = 0").select("customer_id", "trans_date")
    assert clean.join(fraud, ["customer_id", "trans_date"]).count() == 0
    per_cust = fraud.groupBy("customer_id").agg(F.countDistinct("trans_date").alias("d"))
    assert per_cust.where("d > 2").count() == 0  # a window is one day long (start and end)
    assert g.where("amt < 1 OR merchant IS NULL OR category IS NULL").count() == 0
    assert g.select("trans_num").distinct().count() == g.count()
    g.unpersist()


def test_generation_is_partition_independent(spark):
    a = generation.generate(spark, SF_SMALL).select("trans_num", "amt", "trans_time", "merchant")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = generation.generate(spark, SF_SMALL).select("trans_num", "amt", "trans_time", "merchant")
        assert sorted(a.collect()) == sorted(b.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_summary_matches_rows(spark):
    g = generation.generate(spark, SF_SMALL)
    s = {(r.metric, r.key): r.value for r in generation.summary(g).collect()}
    assert s[("transactions", "")] == g.count()
    assert s[("label", "0")] + s.get(("label", "1"), 0) == g.count()


def test_gamma_amounts_are_those_of_the_fold_and_compiled(spark):
    from riskframe.operators import sampling

    for shape in (0.4, 2.5, -1.0, None):
        rows = spark.range(500).select("id", F.lit(shape).cast("double").alias("k"), F.lit(20.0).alias("t"))
        fold = sampling.gamma_draw(F.col("k"), F.col("t"), "id", "gamma7").alias("x")
        want = {r.id: r.x for r in rows.select("id", fold).collect()}
        out = sampling.with_gamma_amount(rows, F.col("k"), F.col("t"), "id", "amt", 7)
        assert out.columns == ["id", "k", "t", "amt"]
        for r in out.collect():
            assert r.amt == want[r.id] if want[r.id] is None or want[r.id] >= 1 else 1 <= r.amt <= 10
    assert "sequence(2" in out._jdf.queryExecution().analyzed().toString()


def test_time_of_day_text(spark):
    from riskframe.operators import sampling

    rows = spark.range(300).select("id", F.when(F.col("id") > 0, 50.0).alias("w"))
    out = sampling.with_daypart_time(rows, "id", F.col("w"), F.lit(50.0), F.lit(0)).withColumn(
        "was", F.format_string("%02d:%02d:%02d", "hour", "minute", "second"))
    assert out.where("was != trans_time or trans_time is null").count() == 0
    assert "format_string" not in out.drop("was")._jdf.queryExecution().optimizedPlan().toString()
