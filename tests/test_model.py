"""Model keys: rows > 0, a learnable label is learned, a reloaded pipeline scores the same."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from riskframe.plans import detector, prototype


def test_model_roundtrip_scores_equal(spark):
    from __spark_entry__ import queries

    out = queries()["model_roundtrip"](spark, SF_CHECK)
    rows = out.collect()
    assert rows and all(r.same for r in rows)


def test_forest_learns_the_fraud_rule(spark):
    from __spark_entry__ import queries
    from riskframe.operators import metrics

    scored = queries()["rf_fit_score"](spark, SF_CHECK)
    auc = metrics.auc_roc(scored.select("is_fraud", F.col("fraud_probability").alias("score"))).first()[0]
    assert auc > 0.8


def test_pca_variance_and_k95(spark):
    from __spark_entry__ import queries

    ev = queries()["pca_variance"](spark, SF_CHECK).collect()
    total = [r.explained_variance for r in ev if r.component == 0][0]
    assert 0 < total <= 1.0 + 1e-9
    k = queries()["pca_k95"](spark, SF_CHECK).first()[0]
    assert 1 <= k <= 18


def test_detector_end_to_end_metrics(spark):
    from __spark_entry__ import queries

    m = {r.metric: r.value for r in queries()["detector_e2e"](spark, SF_CHECK).collect()}
    assert set(m) == {"accuracy", "f1", "precision", "recall", "auc_roc", "auc_pr"}
    assert all(0.0 <= v <= 1.0 for v in m.values())
    assert m["auc_roc"] > 0.8


def test_searches_run_the_whole_grid(spark, monkeypatch):
    """Both registered searches fit the grid of 50/100 trees and depths 5/10/15 over three folds (the fits are recorded)."""
    from __spark_entry__ import queries
    from conftest import SF_SMALL

    met, forest = [], detector.forest

    def small(cfg, num_trees=None, max_depth=None):
        met.append((num_trees, max_depth))
        return forest(cfg, 1, 1)

    monkeypatch.setattr(detector, "forest", small)
    whole = [(t, d) for t in (50, 100) for d in (5, 10, 15)]
    rows = queries()["cv_search"](spark, SF_SMALL).collect()
    assert sorted((r.num_trees, r.max_depth) for r in rows) == whole
    assert sorted(met) == sorted(whole * 3)
    met.clear()
    queries()["detector_e2e"](spark, SF_SMALL)
    assert sorted(met[:-1]) == sorted(whole * 3) and met[-1] in whole  # the last fit is the chosen one


def test_grid_search_goes_on_where_it_stopped(spark, monkeypatch, tmp_path):
    from conftest import SF_SMALL
    from riskframe.sources.tables import txn

    cfg = detector.DetectorConfig(num_trees=[2, 3], max_depth=[2, 3], folds=2)
    frame = detector.model_frame(txn(spark, SF_SMALL), cfg).where(detector.has_features())
    prep = detector.preprocessing(cfg).fit(frame)
    train = detector.training_rows(prep.transform(frame), cfg)
    whole = detector.grid_search(train, cfg, str(tmp_path / "whole"))
    fits, forest = [], detector.forest

    def stops(cfg, num_trees=None, max_depth=None):
        if len(fits) == 3:
            raise RuntimeError("lost")
        fits.append((num_trees, max_depth))
        return forest(cfg, num_trees, max_depth)

    log = str(tmp_path / "log")
    monkeypatch.setattr(detector, "forest", stops)
    with pytest.raises(RuntimeError):
        detector.grid_search(train, cfg, log)
    monkeypatch.setattr(detector, "forest", lambda *a: fits.append(a[1:]) or forest(*a))
    assert detector.grid_search(train, cfg, log) == whole and len(fits) == 8
    assert detector.grid_search(train, cfg, log) == whole and len(fits) == 8
    # other rows: nothing is taken from the log
    detector.grid_search(train.where("event_id % 2 = 0"), cfg, log)
    assert len(fits) == 16


def test_model_does_not_depend_on_partitions(spark):
    from conftest import SF_SMALL
    from riskframe.sources.tables import txn

    cfg = detector.DetectorConfig(num_trees=[4], max_depth=[4])
    frame = detector.model_frame(txn(spark, SF_SMALL), cfg).where(detector.has_features())

    def scores(rows):
        rows = detector.checkpointed(rows, "event_id")
        prep = detector.preprocessing(cfg).fit(rows)
        model = detector.forest(cfg).fit(detector.training_rows(prep.transform(rows), cfg))
        out = detector.score_columns(model.transform(prep.transform(rows)), cfg).collect()
        return sorted((r.event_id, r.prediction, round(r.fraud_probability, 9)) for r in out)

    assert scores(frame.repartition(1)) == scores(frame.repartition(7))


@pytest.fixture(scope="module")
def prototype_run(spark):
    from riskframe.sources.tables import txn

    cfg = prototype.PrototypeConfig(num_trees=10, max_depth=6)
    t = txn(spark, SF_CHECK)
    lacking = t.limit(3).withColumns({"amt": F.lit(None).cast("double"), "event_id": -F.col("event_id") - 1})
    lacking = lacking.withColumn("zip", F.when(F.col("event_id") % 2 == 0, "x").otherwise(F.col("zip")))
    return t, prototype.run_prototype(spark, t.union(t.limit(50)).union(lacking), cfg)


def test_prototype_report_is_that_of_its_predictions(spark, prototype_run):
    import duckdb

    t, run = prototype_run
    scored = run.scored.toPandas()
    assert sorted(scored.event_id) == sorted(r.event_id for r in detector.sampling.hash_split(t, "event_id").where("split = 'test'").collect())
    expected = duckdb.sql("""
        WITH per AS (SELECT cls, sum(tp) tp, sum(s) s, sum(q) q FROM (
            SELECT is_fraud cls, (is_fraud = prediction)::INT tp, 1 s, 0 q FROM scored
            UNION ALL SELECT prediction, 0, 0, 1 FROM scored) GROUP BY cls),
        m AS (SELECT *, CASE WHEN q = 0 THEN 0 ELSE tp / q END p, CASE WHEN s = 0 THEN 0 ELSE tp / s END r FROM per),
        f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END f FROM m)
        SELECT cls::VARCHAR, p, r, f, s FROM f UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(s), sum(s) FROM f
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM f
        UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM f""").fetchall()
    got = [tuple(r) for r in run.report.collect()]
    assert len(got) == 5
    for a, b in zip(sorted(got), sorted(expected)):
        assert a[0] == b[0] and a[4] == b[4]
        assert all((x is None and y is None) or abs(x - y) < 1e-12 for x, y in zip(a[1:4], b[1:4]))
    assert next(r for r in got if r[0] == "1")[2] > 0.5  # recall of the rare class


def test_prototype_applies_its_components_and_balances(spark, prototype_run):
    t, run = prototype_run
    assert 1 <= run.components <= 18 and sum(run.explained) == pytest.approx(1)
    assert sum(run.explained[:run.components]) >= 0.95 or run.components == 18
    assert run.components == 1 or sum(run.explained[:run.components - 1]) < 0.95
    train = detector.sampling.hash_split(t, "event_id").where("split = 'train'").groupBy("is_fraud").count().collect()
    n = {r.is_fraud: r["count"] for r in train}
    assert run.synthetic.count() == max(n.values()) - min(n.values())
    assert {len(r.features) for r in run.synthetic.select("features").limit(5).collect()} == {run.components}
    assert {r.weight for r in run.synthetic.select("weight").distinct().collect()} == {1.0}
    rejects = [sorted(r.missing) for r in run.rejects.collect()]
    assert len(rejects) == 3 and all("amt" in m for m in rejects)


def test_prototype_scaling_and_dummies(spark):
    rows = spark.createDataFrame([(i, i % 2, "train" if i % 4 else "test", "abcd"[i % 4] if i < 40 else "e") for i in range(60)],
                                 "event_id long, is_fraud int, split string, category string")
    rows = rows.withColumns({c: (F.col("event_id") * (j + 1) % 7).cast("double") for j, c in enumerate(prototype.NUMERIC)})
    rows = rows.withColumn("lat", F.lit(4.0))
    x, names = prototype.inputs(rows)
    # test drops a, train drops b; either keeps the others
    assert names[11:] == ["category_c", "category_d", "category_e"]
    got = prototype.centred(x, len(names)).orderBy("event_id").collect()
    raw = np.array([[float(i * (j + 1) % 7) if c != "lat" else 4.0 for j, c in enumerate(prototype.NUMERIC)]
                    + [float(("abcd"[i % 4] if i < 40 else "e") == c) for c in "cde"] for i in range(60)])
    train = raw[[i % 4 != 0 for i in range(60)]]
    sd = train.std(axis=0)
    assert np.allclose([r.z for r in got], (raw - train.mean(axis=0)) / np.where(sd == 0, 1, sd))


def test_prototype_components_needed():
    assert prototype.components_needed([0.5, 0.3, 0.16, 0.04], 0.95, 18) == 3
    assert prototype.components_needed([0.5, 0.3, 0.16, 0.04], 0.95, 2) == 2
    assert prototype.components_needed([0.95, 0.05], 0.95, 18) == 1
    assert prototype.components_needed([0.4, 0.4], 0.95, 18) == 2


def test_prototype_of_one_class_or_no_rows(spark):
    from conftest import SF_SMALL
    from riskframe.sources.tables import txn

    t = txn(spark, SF_SMALL)
    with pytest.raises(ValueError):
        prototype.run_prototype(spark, t.where("is_fraud = 0"))
    with pytest.raises(ValueError):
        prototype.run_prototype(spark, t.limit(0))


def test_estimator_partitions_are_bounded():
    assert [detector.partitions(n) for n in (0, 100, 20_000, 6_000_000, 40 << 20)] == [1, 1, 3, 12, 40]


def test_model_frame_is_stored_before_its_checks(spark, monkeypatch):
    """Checks pushed below the join would compute the features once per check."""
    from conftest import SF_SMALL
    from riskframe.plans import q_model

    names = []
    monkeypatch.setattr(q_model, "stored", lambda df, name: names.append(name) or detector.stored(df, name))
    cfg = detector.DetectorConfig()
    frame = q_model._model_frame(spark, SF_SMALL, cfg)
    assert names == ["model-frame"] and frame.count() > 0


def test_prototype_searches_neighbours_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from riskframe.sources.tables import txn

    names = []
    monkeypatch.setattr(prototype, "stored", lambda df, name: names.append(name) or detector.stored(df, name))
    run = prototype.run_prototype(spark, txn(spark, SF_SMALL), prototype.PrototypeConfig(num_trees=2, max_depth=2))
    assert names.count("prototype-synthetic") == 1
    assert "seq" not in run.synthetic._jdf.queryExecution().analyzed().toString()
