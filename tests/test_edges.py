"""Hand-made edge frames (empty input, one class, ties, NULLs, bad text, overlaps, leap days)."""

import datetime
import math
import random

import pytest

from pyspark.sql import functions as F

from riskframe.functions import dates
from riskframe.operators import assign, fences, calendar, encode, sampling, stats
from riskframe.sources import dims

TXN_SCHEMA = "event_id bigint, is_fraud int, amt double"


def test_empty_fraud_rate_is_null(spark):
    df = spark.createDataFrame([], TXN_SCHEMA)
    row = stats.fraud_rate(df).first()
    assert row["total"] == 0 and row["fraud"] == 0 and row["fraud_rate"] is None


def test_one_class_only_balance_unchanged(spark):
    df = spark.createDataFrame([(i, 0, 10.0) for i in range(5)], TXN_SCHEMA)
    out = sampling.balance_oversample(df, "event_id")
    assert sorted(r.event_id for r in out.collect()) == list(range(5))


def test_twenty_percent_fraud_unchanged(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0, 10.0) for i in range(10)], TXN_SCHEMA)
    out = sampling.balance_oversample(df, "event_id")
    assert out.count() == 10 and out.where("copy > 1").count() == 0


def test_oversample_reaches_target_share(spark):
    rows = [(i, 1 if i < 50 else 0, 1.0) for i in range(5000)]
    out = sampling.balance_oversample(spark.createDataFrame(rows, TXN_SCHEMA), "event_id")
    n1 = out.where("is_fraud = 1").count()
    r = 0.3 * 4950 / (50 * 0.7)  # expected copies per minority row
    expected, sd = 50 * r, (50 * 0.25) ** 0.5 + 1
    assert abs(n1 - expected) <= 3 * sd + 1
    assert out.where("is_fraud = 0").count() == 4950


def test_equal_amounts_single_bin(spark):
    df = spark.createDataFrame([(i, 0, 7.0) for i in range(4)], TXN_SCHEMA)
    rows = stats.equal_width_histogram(df, "amt").collect()
    assert len(rows) == 1 and rows[0]["bin_id"] == 0 and rows[0]["frequency"] == 4 and rows[0]["percentage"] == 100.0


def test_histogram_max_opens_extra_bin_unless_closed(spark):
    df = spark.createDataFrame([(i, 0, float(i)) for i in range(21)], TXN_SCHEMA)
    open_bins = {r["bin_id"] for r in stats.equal_width_histogram(df, "amt").collect()}
    closed_bins = {r["bin_id"] for r in stats.equal_width_histogram(df, "amt", closed=True).collect()}
    assert 20 in open_bins and max(closed_bins) == 19


def test_amount_bands_with_null(spark):
    df = spark.createDataFrame([(1, 0, 50.0), (2, 0, 200.0), (3, 0, 500.0), (4, 0, None)], TXN_SCHEMA)
    got = [r["b"] for r in df.orderBy("event_id").select(stats.amount_band("amt").alias("b")).collect()]
    assert got == ["medium", "high", "very_high", "very_high"]


def test_multi_format_dates(spark):
    df = spark.createDataFrame([("01-31-2023",), ("2023-01-31",), ("31/01/2023",), ("bad",)], "s string")
    got = [r["d"] for r in df.select(dates.parse_date_multi("s").alias("d")).collect()]
    day = datetime.date(2023, 1, 31)
    assert got == [day, day, day, None]


def test_rejects_bad_rows_without_exception(spark):
    from riskframe.plans.q_sources import BAD_ROWS

    df = spark.createDataFrame(BAD_ROWS, "rec_id string, d string, t string, a string")
    amt = F.col("a").try_cast("double")
    out = df.select("rec_id", F.try_to_date("d", "yyyy-MM-dd").alias("d"), amt.alias("a")).collect()
    assert {r.rec_id for r in out if r.d is None} == {"bad-1", "bad-4"}
    assert {r.rec_id for r in out if r.a is None} == {"bad-3"}


def test_segment_rules_first_match_and_leftovers(spark):
    rules = {
        "a.json": {"gender": ["F"], "age": {"min": 18, "max": 40}, "city_pop": {"min": 0, "max": -1}},
        "b.json": {"gender": ["F", "M"], "age": {"min": 30, "max": -1}, "city_pop": {"min": 0, "max": 1000}},
    }
    cust = spark.createDataFrame([(1, "M", 20, 500), (2, "M", 35, 500), (3, "F", 35, 500)],
                                 "customer_id bigint, gender string, age int, city_pop bigint")
    out = {r.customer_id: (r.profile, r.n_matches)
           for r in assign.first_matching_rule(cust, dims.segment_rules(spark, rules)).collect()}
    assert out == {1: ("leftovers.json", 0), 2: ("b.json", 1), 3: ("a.json", 2)}


def test_open_upper_bound_from_negative_max(spark):
    rows = dims.segment_rules(spark, {"x": {"gender": ["F"], "age": {"min": 1, "max": -1},
                                            "city_pop": {"min": 0, "max": 5}}}).collect()
    assert rows[0]["age_max"] is None and rows[0]["pop_max"] == 5.0


def test_cdf_draw_edges_each_row_matches_once(spark):
    dim = assign.cdf_dim(spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "k string, w double"), "k", "w")
    draws = spark.createDataFrame([(1, 1e-12), (2, 0.5), (3, 0.25), (4, 1.0)], "id int, u double")
    got = {r.id: r.k for r in assign.range_lookup(draws, "u", dim).collect()}
    assert got == {1: "a", 2: "b", 3: "a", 4: "c"}
    last = dim.orderBy(F.col("k").desc()).first()
    assert last["hi"] == 1.0


def test_nearest_key_ties_go_low_and_ends_clamp(spark):
    keys = spark.createDataFrame([("a", 0.2), ("b", 0.4), ("c", 0.8)], "name string, key double")
    dim = assign.nearest_dim(keys, "key")
    draws = spark.createDataFrame([(1, 0.05), (2, 0.3), (3, 0.61), (4, 1.0)], "id int, u double")
    got = {r.id: r.name for r in assign.range_lookup(draws, "u", dim).collect()}
    assert got == {1: "a", 2: "a", 3: "c", 4: "c"}


def test_feb29_weight_only_in_leap_years(spark):
    days = spark.createDataFrame([(datetime.date(2024, 2, 29),), (datetime.date(2023, 2, 28),),
                                  (datetime.date(2023, 3, 1),)], "date date")
    cal = calendar.calendar_weights(spark, days)
    got = {r.date: r.weight for r in cal.collect()}
    assert got[datetime.date(2024, 2, 29)] > 0
    assert abs(sum(got.values()) - 1.0) < 1e-12


def test_category_only_in_test_gets_dummy_zero_in_train(spark):
    df = spark.createDataFrame([(1, "train", "a"), (2, "train", "b"), (3, "test", "a"), (4, "test", "c")],
                               "id bigint, split string, category string")
    out = encode.aligned_dummies(df, "id", "category", "split").collect()
    cols = {r.dummy for r in out}
    assert cols == {"category_b", "category_c"}
    assert all(r.value == 0 for r in out if r.split == "train" and r.dummy == "category_c")
    assert [r.value for r in out if r.id == 4 and r.dummy == "category_c"] == [1]


def test_dob_from_age_is_consistent(spark):
    from riskframe.functions.numeric import round_half_up  # noqa: F401

    df = spark.range(2000).select(F.col("id"), (F.lit(18) + F.col("id") % 70).alias("age"))
    out = dates.with_dob_from_age(df, "age", "id", "2025-01-01").select("age", "dob").collect()
    for r in out:
        as_of = datetime.date(2025, 1, 1)
        years = as_of.year - r.dob.year - ((as_of.month, as_of.day) < (r.dob.month, r.dob.day))
        assert years == r.age


def test_partitioned_read_merges_schemas(spark):
    from riskframe.session import scratch_path
    from riskframe.sources import files

    path = scratch_path(spark, "merge")
    a = spark.createDataFrame([(1, 2023, 1, "x")], "id bigint, year int, month int, a string")
    b = spark.createDataFrame([(2, 2024, 2, 5.0)], "id bigint, year int, month int, b double")
    files.write_partitioned(a, path, ["year", "month"], mode="append")
    files.write_partitioned(b, path, ["year", "month"], mode="append")
    back = files.read_partitioned(spark, path)
    assert set(back.columns) == {"id", "a", "b", "year", "month"}
    rows = {r.id: r for r in back.collect()}
    assert rows[1].a == "x" and rows[1].b is None and rows[2].b == 5.0 and rows[2].year == 2024
    pruned = back.where("month = 2")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters:")[1][:120]
    assert pruned.count() == 1


def test_poisson_oversample_mean_and_partition_independence(spark):
    rows = [(i, 1 if i < 400 else 0, 1.0) for i in range(40000)]
    df = spark.createDataFrame(rows, TXN_SCHEMA)
    r = 0.3 * 39600 / (400 * 0.7)
    a = sampling.balance_oversample(df.repartition(3), "event_id", method="poisson")
    b = sampling.balance_oversample(df.repartition(5), "event_id", method="poisson")
    n1 = a.where("is_fraud = 1").count()
    assert abs(n1 - 400 * r) <= 3 * (400 * r) ** 0.5
    assert sorted((x.event_id, x.copy) for x in a.where("is_fraud = 1").collect()) == \
        sorted((x.event_id, x.copy) for x in b.where("is_fraud = 1").collect())
    per_row = a.where("is_fraud = 1").groupBy("event_id").count().select("count").distinct().count()
    assert per_row > 2  # Poisson spread, not just floor(r) / floor(r) + 1


def test_smote_with_one_minority_row_gives_none(spark):
    from riskframe.operators.smote import smote

    points = spark.createDataFrame([(i, [float(i), 1.0], int(i == 3)) for i in range(8)], "id long, v array<double>, y int")
    assert smote(points, "id", "v", "y", 1).collect() == []


def test_poisson_counts_at_small_and_large_rates(spark):
    for rate, draws in ((1.0, 400), (100.0, 400), (800.0, 200), (2_000.0, 100), (100_000.0, 20)):
        us = spark.createDataFrame([((i + 0.5) / draws,) for i in range(draws)], "u double")
        ks = [r.k for r in us.select(sampling.poisson_count(F.lit(rate), F.col("u")).alias("k")).collect()]
        mean = sum(ks) / draws
        sd = (sum((k - mean) ** 2 for k in ks) / draws) ** 0.5
        assert abs(mean - rate) < 0.1 * rate ** 0.5 and abs(sd - rate ** 0.5) < 0.1 * rate ** 0.5, (rate, mean, sd)


def test_many_copies_of_one_row(spark):
    df = spark.createDataFrame([(i, 1 if i == 0 else 0, 10.0) for i in range(30_000)], TXN_SCHEMA)
    out = sampling.balance_oversample(df, "event_id").where("is_fraud = 1").agg(
        F.count("*").alias("n"), F.min("copy").alias("lo"), F.max("copy").alias("hi"), F.countDistinct("copy").alias("d")).first()
    assert out.lo == 1 and out.n == out.hi == out.d and out.n > 2 * sampling.COPIES_AT_ONCE


def test_tiny_weights_keep_their_intervals_at_every_depth(spark, monkeypatch):
    w = spark.createDataFrame([(f"k{i:02d}", 1e-11) for i in range(20)] + [("z", 1e-9)], "k string, w double")
    small = {r.k: (r.lo, r.hi) for r in assign.cdf_dim(w, "k", "w").collect()}
    monkeypatch.setattr(fences, "ROOT", 3)
    monkeypatch.setattr(fences, "RUN", 2)
    large = {r.k: (r.lo, r.hi) for r in assign.cdf_dim(w, "k", "w").collect()}
    assert all(lo < hi for lo, hi in large.values())
    assert small == large


def test_cdf_of_zero_null_and_no_weights(spark):
    kind = "k string, w double"
    dim = assign.cdf_dim(spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 0.0), ("d", 3.0), (None, 9.0), ("e", None)], kind), "k", "w")
    assert sorted((r.k, r.lo, r.hi) for r in dim.collect()) == [("a", 0.0, 0.0), ("b", 0.0, 0.25), ("c", 0.25, 0.25), ("d", 0.25, 1.0)]
    draws = spark.createDataFrame([(1, 0.1), (2, 0.25), (3, 0.26), (4, None)], "id int, u double")
    assert sorted((r.id, r.k) for r in assign.range_lookup(draws, "u", dim).collect()) == [(1, "b"), (2, "b"), (3, "d"), (4, None)]
    assert assign.cdf_dim(spark.createDataFrame([], kind), "k", "w").collect() == []
    none = assign.cdf_dim(spark.createDataFrame([("a", 0.0), ("b", 0.0)], kind), "k", "w")
    assert [r.k for r in assign.range_lookup(draws, "u", none).collect()] == [None] * 4
    assert [r.k for r in assign.range_lookup(draws, "u", none.limit(0)).collect()] == [None] * 4


def test_keys_with_a_long_common_prefix_spread_over_the_buckets(spark):
    from riskframe.operators import prefix

    keys = [f"Customer#{i:018d}" for i in range(2_000)]
    df = spark.createDataFrame([(k, 1) for k in keys] + [(None, 1)], "k string, n long")
    rows = prefix._bucketed(df, "k", 64).groupBy("_bk").count().collect()
    assert len(rows) == 64 and max(r["count"] for r in rows) < 100
    totals = {r.k: r.n_before for r in prefix.running_totals(df.where("k is not null"), "k", ["n"]).collect()}
    assert totals == {k: i for i, k in enumerate(keys)}


def test_bigint_quantile_keeps_its_digits(spark):
    from riskframe.operators.quantile import exact_quantile

    big = 9_007_199_254_740_993
    df = spark.createDataFrame([(big - 1,), (big,), (big + 1,), (-(1 << 63),), ((1 << 63) - 1,)], "x bigint")
    assert exact_quantile(df, "x", 0.6) == big
    assert exact_quantile(df, "x", 1.0) == (1 << 63) - 1


def test_report_has_classes_that_are_only_predicted(spark):
    from riskframe.operators import metrics

    df = spark.createDataFrame([(0, 0), (0, 2), (1, 1)], "is_fraud int, prediction int")
    rep = {r.cls: r for r in metrics.class_report(df).collect()}
    assert set(rep) == {0, 1, 2}
    assert (rep[2].support, rep[2].precision, rep[2].recall, rep[2].f1) == (0, 0.0, 0.0, 0.0)
    assert abs(metrics.weighted_metrics(df).first()["accuracy"] - 2 / 3) < 1e-12


def test_rewrite_drops_partitions_that_are_gone(spark, tmp_path):
    from riskframe.sources import files

    path = str(tmp_path / "t")
    both = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    one = both.where("p = 'a'")
    files.write_partitioned(both, path, ["p"])
    files.write_partitioned(one, path, ["p"], overwrite="dynamic")
    assert files.read_partitioned(spark, path).count() == 2
    files.write_partitioned(one, path, ["p"])
    assert [r.p for r in files.read_partitioned(spark, path).collect()] == ["a"]


def test_rows_without_features_are_rejected_and_the_rest_is_modelled(spark):
    from conftest import SF_CHECK
    from riskframe.plans import detector
    from riskframe.sources.tables import txn

    t = txn(spark, SF_CHECK)
    gone = [r.event_id for r in t.select("event_id").orderBy("event_id").limit(2).collect()]
    holes = t.withColumn("amt", F.when(F.col("event_id") != gone[0], F.col("amt"))).withColumn(
        "zip", F.when(F.col("event_id") == gone[1], F.lit("no zip")).otherwise(F.col("zip")))
    run = detector.run_detector(spark, holes, detector.DetectorConfig(num_trees=[3], max_depth=[2, 3]))
    rejects = {r.event_id: r.missing for r in run.rejects.collect()}
    assert set(gone) <= set(rejects)
    assert "amt" in rejects[gone[0]] and rejects[gone[1]] == ["zip_numeric"]
    bad = run.scored.where(F.isnan("fraud_probability") | F.col("event_id").isin(gone)).count()
    assert bad == 0 and run.scored.count() > 0


def test_exact_quantile_of_odd_columns(spark):
    from riskframe.operators.quantile import exact_quantile

    rnd = random.Random(4)
    columns = [[1.0], [2.0] * 50, [0.0] * 999 + [1e300], [-1e-300, 0.0, 1e-300], [float(rnd.randrange(5)) for _ in range(300)],
               [rnd.lognormvariate(0, 6) for _ in range(3_000)]]
    for vals in columns:
        df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
        for p in (0.0, 0.1, 0.5, 0.999, 1.0):
            assert exact_quantile(df, "v", p) == sorted(vals)[max(1, math.ceil(p * len(vals))) - 1]
    assert exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


def test_sketched_quantiles_measure_their_error(spark):
    from riskframe.operators.quantile import sketched_quantiles

    rnd = random.Random(5)
    rows = [("a", rnd.random()) for _ in range(5_000)] + [("b", 1.0)] * 40 + [("c", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    for accuracy in (10, 10_000):
        got = {(r.g, r.p): r for r in sketched_quantiles(df, ["g"], "v", [0.1, 0.5], accuracy).collect()}
        assert {k[0] for k in got} == {"a", "b"}  # a null group joins no other, c has no values
        vals = sorted(v for g, v in rows if g == "a")
        for p in (0.1, 0.5):
            r = got["a", p]
            assert (r.n, r.rank_low, r.rank_high) == (5_000, sum(v < r.value for v in vals), sum(v <= r.value for v in vals))
            want = math.ceil(p * 5_000)
            assert r.rank_error == pytest.approx(max(r.rank_low + 1 - want, want - r.rank_high, 0) / 5_000)
            assert r.rank_error <= 1.5 / accuracy and got["b", p].rank_error == 0
    whole = sketched_quantiles(df, [], "v", [0.5]).collect()
    assert len(whole) == 1 and whole[0].n == 5_041 and whole[0].rank_error <= 1e-4
