"""Invariants: partition independence, complete splits, exact distributed helpers vs brute force."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskframe.operators import assign, fences, metrics, prefix, sampling
from riskframe.operators.quantile import exact_quantile
from riskframe.sources.tables import txn


def test_split_and_folds_disjoint_complete(spark):
    t = txn(spark, SF_SMALL).select("event_id")
    s = sampling.assign_folds(sampling.hash_split(t, "event_id"), "event_id", 3)
    rows = s.collect()
    assert len(rows) == t.count()
    assert {r.split for r in rows} == {"train", "test"}
    assert {r.fold for r in rows} == {0, 1, 2}


def test_same_result_after_repartition(spark):
    t = txn(spark, SF_SMALL).select("event_id", "is_fraud")

    def run(df):
        out = sampling.balance_oversample(sampling.hash_split(df, "event_id"), "event_id")
        return sorted((r.event_id, r.copy, r.split) for r in out.collect())

    assert run(t.repartition(1)) == run(t.repartition(7))


def test_running_totals_match_brute_force(spark):
    rng = np.random.default_rng(0)
    vals = [(float(k), int(v)) for k, v in zip(rng.permutation(500), rng.integers(0, 10, 500))]
    df = spark.createDataFrame(vals, "k double, v bigint")
    got = {r.k: r.v_before for r in prefix.running_totals(df, "k", ["v"], descending=True, buckets=7).collect()}
    srt = sorted(vals, key=lambda x: -x[0])
    acc = 0
    for k, v in srt:
        assert got[k] == acc
        acc += v


@pytest.mark.parametrize("partitions", ["8", "300"])
def test_ranges_follow_the_sessions_partitions(spark, partitions):
    """The number of ranges is the session's, totals are the same: no keys, equal ends, NaN and infinities included."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        keys = [float("-inf"), *[i / 7 for i in range(-400, 400)], float("inf"), float("nan")]
        df = spark.createDataFrame([(k, 2) for k in keys], "k double, v bigint")
        for down in (False, True):
            got = prefix.running_totals(df, "k", ["v"], descending=down).collect()
            order = list(reversed(keys)) if down else keys
            assert {str(r.k): r.v_before for r in got} == {str(k): 2 * i for i, k in enumerate(order)}
        ranges = prefix._bucketed(df, "k", max(prefix.LEAST, int(partitions))).select("_bk").distinct().count()
        assert ranges == max(prefix.LEAST, int(partitions))
        assert prefix.running_totals(df.limit(0), "k", ["v"]).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_index_table_matches_indexer(spark):
    """Many distinct values with ties in their counts, nulls and empty strings."""
    from riskframe.operators import encode

    rng = np.random.default_rng(8)
    values = [(None,), ("",)] + [(f"v{int(x)}",) for x in rng.zipf(1.3, 4_000) % 1_500]
    df = spark.createDataFrame(values, "c string")
    labels = encode.string_indexers(["c"])[0].fit(df.where("c is not null")).labelsArray[0]
    got = sorted((r.idx, r.value) for r in encode.index_table(df, "c").collect())
    assert got == list(enumerate(labels)) and len(got) > 500
    assert encode.index_table(df.limit(0), "c").collect() == []
    windows = [w for w in encode.index_table(df, "c")._jdf.queryExecution().analyzed().toString().split("\n") if "windowspec" in w.lower()]
    assert windows and not any("row_number" in w for w in windows)


def test_exact_quantile_matches_numpy(spark):
    rng = np.random.default_rng(1)
    xs = np.round(rng.gamma(2.0, 30.0, 5001), 2)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    for p in (0.1, 0.5, 0.9):
        k = max(1, int(np.ceil(p * len(xs))))
        assert exact_quantile(df, "x", p, buckets=16) == float(np.sort(xs)[k - 1])


def test_auc_matches_mllib_unbinned(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + 0.3 * y, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "is_fraud int, score double")
    ours_roc = metrics.auc_roc(df).first()[0]
    ours_pr = metrics.auc_pr(df).first()[0]
    lab = df.select("score", F.col("is_fraud").cast("double").alias("label"))

    def mllib(name):
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=name, numBins=0)
        return ev.evaluate(lab)

    assert abs(ours_roc - mllib("areaUnderROC")) < 1e-9
    assert abs(ours_pr - mllib("areaUnderPR")) < 1e-9


def test_index_within_group_is_bijection(spark):
    items = spark.createDataFrame([("g1" if i % 3 else "g2", f"item{i:04d}") for i in range(300)], "g string, item string")
    idx = assign.index_within_group(items, "g", "item", buckets=5).collect()
    for g in ("g1", "g2"):
        got = sorted(r.idx for r in idx if r.g == g)
        assert got == list(range(1, len(got) + 1))


def test_cdf_shares_sum_to_one(spark):
    w = spark.createDataFrame([(f"k{i}", float(i + 1)) for i in range(20)], "k string, w double")
    d = assign.cdf_dim(w, "k", "w").orderBy("k").collect()
    assert d[0]["lo"] == 0.0 and d[-1]["hi"] == 1.0
    assert all(a["hi"] == b["lo"] for a, b in zip(d, d[1:]))


def test_histogram_shares_sum_to_100(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert abs(sum(r.percentage for r in rows) - 100.0) < 0.2
    assert sum(r.frequency for r in rows) == txn(spark, SF_SMALL).where("amt IS NOT NULL").count()


def test_window_free_of_global_sort_in_histogram_plan(spark):
    from __spark_entry__ import entry

    plan = entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan or "BroadcastExchange" in plan
    _ = Window  # the share window runs after aggregation on <= bins + 1 rows


def test_exact_knn_many_cells_with_duplicates_matches_brute_force(spark):
    from riskframe.operators.knn import exact_knn

    rng = np.random.default_rng(3)
    base = np.round(rng.normal(size=(120, 4)), 3)
    vecs = np.concatenate([base, np.repeat(base[:3], 9, axis=0)])  # groups of copies
    ids = rng.permutation(len(vecs)) + 1000
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vecs)], "id bigint, v array<double>")
    k = 4
    got = {}
    for r in exact_knn(df, "id", "v", k=k, block_bytes=7 * 32).collect():
        got.setdefault(r.id, []).append((r.rank, r.nbr_id, round(r.dist, 9)))
    for qi, q in enumerate(ids):
        d = np.sqrt(((vecs - vecs[qi]) ** 2).sum(axis=1))
        cand = sorted((round(float(d[j]), 9), int(ids[j])) for j in range(len(ids)) if ids[j] != q)[:k]
        mine = sorted(got[int(q)])
        assert [(n, dd) for _, n, dd in mine] == [(n, dd) for dd, n in cand], q


def test_exact_knn_dense_cluster_refines_cells(spark):
    from riskframe.operators.knn import exact_knn

    rng = np.random.default_rng(4)
    spread = np.round(rng.normal(size=(60, 3)) * 10, 4)
    dense = np.round(rng.normal(size=(200, 3)) * 0.001 + 5.0, 6)  # one tight cluster: most of the points
    vecs = np.concatenate([spread, dense])
    ids = np.arange(len(vecs)) + 1
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vecs)], "id bigint, v array<double>")
    k = 3
    got = {}
    for r in exact_knn(df, "id", "v", k=k, block_bytes=10 * 24).collect():
        got.setdefault(r.id, []).append((r.rank, r.nbr_id))
    for qi, q in enumerate(ids):
        d = np.sqrt(((vecs - vecs[qi]) ** 2).sum(axis=1))
        cand = [int(ids[j]) for j in sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (d[j], ids[j]))[:k]]
        assert [n for _, n in sorted(got[int(q)])] == cand, q


def test_exact_knn_of_all_embeddings(spark):
    """Whole table, in one block and in many; null, NaN and empty vectors take no part."""
    from riskframe.operators.knn import exact_knn

    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = emb.orderBy("vec_id").collect()
    ids, vecs = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    bad = spark.createDataFrame([(-1, None), (-2, [float("nan")] * 64), (-3, []), (None, [0.5] * 64), (-4, [None] + [0.0] * 63)], emb.schema)
    expected = set()
    for at in range(0, len(ids), 250):
        dist = np.sqrt(((vecs[at:at + 250, None, :] - vecs[None, :, :]) ** 2).sum(axis=2))
        for i, d in enumerate(dist):
            order = [j for j in np.lexsort((ids, d)) if j != at + i][:5]
            expected |= {(int(ids[at + i]), r + 1, int(ids[j])) for r, j in enumerate(order)}
    for block_bytes in (1 << 20, 64 * 8 * 60):
        got = exact_knn(emb.union(bad), "vec_id", "embedding", k=5, block_bytes=block_bytes).collect()
        assert {(r.id, r.rank, r.nbr_id) for r in got} == expected and len(got) == len(expected)


def test_exact_knn_ties_and_small_sets(spark):
    from riskframe.operators.knn import exact_knn

    grid = [(x * 7 + y, [float(x), float(y)]) for x in range(7) for y in range(7)] + [(100 + i, [3.0, 3.0]) for i in range(4)]
    df = spark.createDataFrame(grid, "id bigint, v array<double>")
    for block_bytes in (1 << 20, 5 * 16):
        got = {}
        for r in exact_knn(df, "id", "v", k=6, block_bytes=block_bytes).collect():
            got.setdefault(r.id, []).append((r.rank, r.nbr_id))
        for i, v in grid:
            near = sorted((((v[0] - w[0]) ** 2 + (v[1] - w[1]) ** 2) ** 0.5, j) for j, w in grid if j != i)[:6]
            assert [n for _, n in sorted(got[i])] == [j for _, j in near]
    assert exact_knn(df.limit(0), "id", "v").collect() == []
    assert exact_knn(df.limit(1), "id", "v").collect() == []
    assert sorted((r.id, r.nbr_id) for r in exact_knn(df.where("id < 2"), "id", "v").collect()) == [(0, 1), (1, 0)]


@pytest.mark.parametrize("kind", ["double", "int"])
def test_cdf_dim_is_the_same_at_every_depth(spark, monkeypatch, kind):
    rng = np.random.default_rng(5)
    w = spark.createDataFrame([(f"k{i:04d}", x) for i, x in enumerate((rng.integers(0, 50, 300) / (7 if kind == "double" else 1)).tolist())],
                              "k string, w double").withColumn("w", F.col("w").cast(kind))
    flat = {r.k: (r.lo, r.hi) for r in assign.cdf_dim(w, "k", "w").collect()}
    monkeypatch.setattr(fences, "ROOT", 10)
    monkeypatch.setattr(fences, "RUN", 4)
    assert {r.k: (r.lo, r.hi) for r in assign.cdf_dim(w, "k", "w").collect()} == flat
    rows = sorted(flat.items())
    assert rows[0][1][0] == 0.0 and rows[-1][1][1] == 1.0
    assert all(a[1][1] == b[1][0] for a, b in zip(rows, rows[1:]))  # no gaps, no overlaps


def test_lookups_are_the_same_at_every_depth(spark, monkeypatch):
    """Draws below, on, between and above the keys, nulls, one draw that a third of the rows share."""
    rng = np.random.default_rng(6)
    ks = sorted(set(float(x) for x in np.round(rng.random(400) * 0.98 + 0.01, 6)))
    keys = spark.createDataFrame([(f"n{i}", k) for i, k in enumerate(ks)], "name string, key double")
    us = [float(x) for x in rng.random(500)] + ks + [0.0, 1.0, 0.5] + [0.5] * 400
    draws = spark.createDataFrame([*enumerate(us), (-1, None)], "id int, u double")

    def run():
        near = assign.nearest_dim(keys, "key")
        below = {r.id: r.at for r in fences.locate(draws, "u", keys, "key", "at").collect()}
        upto = {r.id: r.at for r in fences.locate(draws, "u", keys, "key", "at", inclusive=True).collect()}
        around = {r.key: (r.prev_key, r.next_key) for r in fences.neighbours(keys, "key").collect()}
        return ({r.name: (r.lo, r.hi) for r in near.collect()}, below, upto, around,
                {r.id: r.name for r in assign.range_lookup(draws, "u", near).collect()})

    flat = run()
    assert flat[1] == {**{i: max((k for k in ks if k < u), default=None) for i, u in enumerate(us)}, -1: None}
    assert flat[2] == {**{i: max((k for k in ks if k <= u), default=None) for i, u in enumerate(us)}, -1: None}
    assert flat[3] == {k: (a, b) for k, a, b in zip(ks, [None, *ks], [*ks[1:], None])}
    for i, u in enumerate(us):
        if u > 0:
            assert abs(ks[int(flat[4][i][1:])] - u) == min(abs(k - u) for k in ks)
    monkeypatch.setattr(fences, "ROOT", 10)
    monkeypatch.setattr(fences, "RUN", 4)
    assert run() == flat


def test_lookup_in_a_million_keys(spark):
    keys = spark.range(1_000_000).select((F.col("id") * 3).cast("double").alias("key"))
    draws = spark.range(2_000).select((F.col("id") * 1499.5 + 1).alias("u"))
    got = fences.locate(draws, "u", keys, "key", "at").collect()
    assert len(got) == 2_000 and all(r.at == min(3 * np.ceil(r.u / 3) - 3, 2_999_997) for r in got)


def test_running_totals_over_fences(spark, monkeypatch):
    monkeypatch.setattr(fences, "ROOT", 5)
    monkeypatch.setattr(fences, "RUN", 3)
    rng = np.random.default_rng(2)
    vals = [(f"k{k:03d}", int(v), int(v) * 2) for k, v in zip(rng.permutation(200), rng.integers(0, 10, 200))]
    got = {r.k: (r.a_before, r.b_before) for r in fences.running_totals(spark.createDataFrame(vals, "k string, a long, b long"), "k", ["a", "b"]).collect()}
    acc = 0
    for k, a, b in sorted(vals):
        assert got[k] == (acc, 2 * acc)
        acc += a



def test_knn_block_is_cut_only_for_queries_without_a_bound(monkeypatch):
    """Later blocks meet a k-th distance; ordering their products again costs most of the search."""
    import numpy as np

    from riskframe.operators import knn

    rng = np.random.default_rng(7)
    points, k = np.round(rng.normal(size=(900, 4)) + 1e3, 1), 3
    ids = np.full((900, k + 1), knn.NO_ID, np.int64)
    ids[:, 0] = np.arange(900)
    best = knn._Best(points[:300], ids[:300], k)
    best.merge(points[:300], ids[:300], np.arange(300))
    monkeypatch.setattr(np, "partition", None)
    for at in (300, 600):
        best.merge(points[at:at + 300], ids[at:at + 300], np.arange(300))
    found = best.rows().column(1).to_pylist()
    for i in range(300):
        dist = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
        order = np.lexsort((np.arange(900), dist))[:k + 1]
        assert [(s["dist"], s["nbr_id"]) for s in found[i]] == [(dist[j], j) for j in order]
