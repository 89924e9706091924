"""Metric queries on a fixed scoring rule over ``txn``.

prediction = 1 when amt >= 80, score = floor(amt); so the metric operators are checked
exactly, apart from any model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.numeric import round_half_up as rh
from riskframe.functions.numeric import sql_round_half_up as R
from riskframe.operators import metrics
from riskframe.plans.catalog import query
from riskframe.sources.tables import txn, with_txn

SCORED_CTE = """scored AS (SELECT event_id, is_fraud, CAST(amt >= 80 AS INTEGER) AS prediction,
                                CAST(floor(amt) AS DOUBLE) AS score FROM txn)"""


def scored(spark, sf_dir):
    return txn(spark, sf_dir).select(
        "event_id", "is_fraud", (F.col("amt") >= 80).cast("int").alias("prediction"),
        F.floor("amt").cast("double").alias("score"),
    )


def _sql(body, extra=""):
    return with_txn(body, SCORED_CTE + (",\n" + extra if extra else ""))


@query("confusion_matrix", _sql("""
SELECT CAST(is_fraud AS BIGINT) AS label, CAST(prediction AS BIGINT) AS prediction, COUNT(*) AS n
FROM scored GROUP BY 1, 2"""))
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir))


BIN_CTE = """bcnt AS (SELECT CAST(SUM(CASE WHEN is_fraud = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
                 CAST(SUM(CASE WHEN is_fraud = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                 CAST(SUM(CASE WHEN is_fraud = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
                 CAST(SUM(CASE WHEN is_fraud = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM scored),
bpr AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall FROM bcnt),
bm AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM bpr)"""


@query("binary_metrics", _sql(f"""
SELECT tn, fp, fn, tp, {R('precision', 10)} AS precision, {R('recall', 10)} AS recall, {R('f1', 10)} AS f1 FROM bm""", BIN_CTE))
def binary_metrics(spark, sf_dir):
    m = metrics.binary_metrics(scored(spark, sf_dir))
    return m.select("tn", "fp", "fn", "tp", *[rh(F.col(c), 10).alias(c) for c in ("precision", "recall", "f1")])


REPORT_CTE = """cm AS (SELECT is_fraud AS label, prediction, COUNT(*) AS n FROM scored GROUP BY 1, 2),
sup AS (SELECT label AS cls, SUM(n) AS support FROM cm GROUP BY 1),
tpc AS (SELECT label AS cls, n AS tp FROM cm WHERE label = prediction),
npr AS (SELECT prediction AS cls, SUM(n) AS npred FROM cm GROUP BY 1),
rep0 AS (SELECT s.cls, CASE WHEN COALESCE(p.npred, 0) = 0 THEN 0.0 ELSE CAST(COALESCE(t.tp, 0) AS DOUBLE) / CAST(p.npred AS DOUBLE) END AS precision,
                CASE WHEN s.support = 0 THEN 0.0 ELSE CAST(COALESCE(t.tp, 0) AS DOUBLE) / CAST(s.support AS DOUBLE) END AS recall,
                CAST(s.support AS BIGINT) AS support
         FROM sup s LEFT JOIN tpc t ON t.cls = s.cls LEFT JOIN npr p ON p.cls = s.cls),
rep AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM rep0)"""


@query("class_report", _sql(f"""
SELECT CAST(cls AS BIGINT) AS cls, {R('precision', 10)} AS precision, {R('recall', 10)} AS recall, {R('f1', 10)} AS f1, support
FROM rep""", REPORT_CTE))
def class_report(spark, sf_dir):
    r = metrics.class_report(scored(spark, sf_dir))
    return r.select(F.col("cls").cast("bigint").alias("cls"), *[rh(F.col(c), 10).alias(c) for c in ("precision", "recall", "f1")],
                    "support")


FULL_REPORT_SQL = """per AS (SELECT cls, SUM(tp) AS tp, SUM(support) AS support, SUM(npred) AS npred FROM (
          SELECT is_fraud AS cls, CAST(is_fraud = prediction AS BIGINT) AS tp, 1 AS support, 0 AS npred FROM scored
          UNION ALL SELECT prediction, 0, 0, 1 FROM scored) GROUP BY cls),
pr2 AS (SELECT *, CASE WHEN npred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(npred AS DOUBLE) END AS p,
                  CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) END AS r FROM per),
prf AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2.0 * p * r / (p + r) END AS f FROM pr2),
full_rep AS (
  SELECT CAST(cls AS VARCHAR) AS name, p AS precision, r AS recall, f AS f1, CAST(support AS BIGINT) AS support FROM prf
  UNION ALL SELECT 'accuracy', NULL, NULL, CAST(SUM(tp) AS DOUBLE) / CAST(SUM(support) AS DOUBLE), CAST(SUM(support) AS BIGINT) FROM prf
  UNION ALL SELECT 'macro avg', AVG(p), AVG(r), AVG(f), CAST(SUM(support) AS BIGINT) FROM prf
  UNION ALL SELECT 'weighted avg', SUM(p * support) / SUM(support), SUM(r * support) / SUM(support), SUM(f * support) / SUM(support),
                   CAST(SUM(support) AS BIGINT) FROM prf)"""


@query("class_report_full", _sql(f"""
SELECT name, {R('precision', 10)} AS precision, {R('recall', 10)} AS recall, {R('f1', 10)} AS f1, support FROM full_rep""", FULL_REPORT_SQL))
def class_report_full(spark, sf_dir):
    """Classes, accuracy, macro and weighted averages in one pass (rollup)."""
    r = metrics.full_report(scored(spark, sf_dir))
    return r.select("name", *[rh(F.col(c), 10).alias(c) for c in ("precision", "recall", "f1")], "support")


WEIGHTED_CTE = REPORT_CTE + """,
wm AS (SELECT SUM(w * recall) AS accuracy, SUM(w * precision) AS weighted_precision, SUM(w * recall) AS weighted_recall,
              SUM(w * f1) AS weighted_f1
       FROM (SELECT *, CAST(support AS DOUBLE) / CAST(SUM(support) OVER () AS DOUBLE) AS w FROM rep))"""


@query("weighted_metrics", _sql(f"""
SELECT {R('accuracy', 10)} AS accuracy, {R('weighted_precision', 10)} AS weighted_precision,
       {R('weighted_recall', 10)} AS weighted_recall, {R('weighted_f1', 10)} AS weighted_f1 FROM wm""", WEIGHTED_CTE))
def weighted_metrics(spark, sf_dir):
    m = metrics.weighted_metrics(scored(spark, sf_dir))
    return m.select(*[rh(F.col(c), 10).alias(c) for c in m.columns])


AUC_CTE = """st AS (SELECT score, CAST(SUM(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
                    CAST(SUM(CASE WHEN is_fraud = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM scored GROUP BY score),
stc AS (SELECT *, COALESCE(SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_before,
               COALESCE(SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
               SUM(pos) OVER () AS p_tot, SUM(neg) OVER () AS n_tot FROM st),
roc AS (SELECT CASE WHEN MAX(p_tot) = 0 OR MAX(n_tot) = 0 THEN NULL
                    ELSE SUM(CAST(neg AS DOUBLE) * (CAST(pos_before AS DOUBLE) + CAST(pos AS DOUBLE) / 2.0))
                         / (CAST(MAX(p_tot) AS DOUBLE) * CAST(MAX(n_tot) AS DOUBLE)) END AS auc_roc FROM stc),
prp AS (SELECT *, CAST(pos_before + pos AS DOUBLE) / CAST(pos_before + pos + neg_before + neg AS DOUBLE) AS p_here,
               CAST(pos_before + pos AS DOUBLE) / CAST(p_tot AS DOUBLE) AS r_here,
               CAST(pos_before AS DOUBLE) / CAST(p_tot AS DOUBLE) AS r_prev FROM stc),
pr AS (SELECT CASE WHEN MAX(p_tot) = 0 THEN NULL ELSE SUM((r_here - r_prev) * (p_here + p_prev) / 2.0) END AS auc_pr
       FROM (SELECT *, CASE WHEN pos_before + neg_before = 0 THEN p_here
                            ELSE CAST(pos_before AS DOUBLE) / CAST(pos_before + neg_before AS DOUBLE) END AS p_prev FROM prp))"""


@query("auc_roc", _sql(f"SELECT {R('auc_roc', 10)} AS auc_roc FROM roc", AUC_CTE))
def auc_roc(spark, sf_dir):
    return metrics.auc_roc(scored(spark, sf_dir)).select(rh(F.col("auc_roc"), 10).alias("auc_roc"))


@query("auc_pr", _sql(f"SELECT {R('auc_pr', 10)} AS auc_pr FROM pr", AUC_CTE))
def auc_pr(spark, sf_dir):
    return metrics.auc_pr(scored(spark, sf_dir)).select(rh(F.col("auc_pr"), 10).alias("auc_pr"))


@query("evaluate_all", _sql(f"""
SELECT metric, {R('value', 10)} AS value FROM (
  SELECT 'accuracy' AS metric, accuracy AS value FROM wm
  UNION ALL SELECT 'f1', weighted_f1 FROM wm
  UNION ALL SELECT 'precision', weighted_precision FROM wm
  UNION ALL SELECT 'recall', weighted_recall FROM wm
  UNION ALL SELECT 'auc_roc', auc_roc FROM roc
  UNION ALL SELECT 'auc_pr', auc_pr FROM pr)""", WEIGHTED_CTE + ",\n" + AUC_CTE))
def evaluate_all(spark, sf_dir):
    """The six detector metrics as (metric, value) rows, from one scored frame."""
    from riskframe.plans.detector import checkpointed

    s = checkpointed(scored(spark, sf_dir))  # three aggregates read one materialised frame
    w = metrics.weighted_metrics(s)
    rows = w.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
        F.struct(F.lit("f1").alias("metric"), F.col("weighted_f1").alias("value")),
        F.struct(F.lit("precision").alias("metric"), F.col("weighted_precision").alias("value")),
        F.struct(F.lit("recall").alias("metric"), F.col("weighted_recall").alias("value")),
    )).alias("m")).select("m.metric", "m.value")
    roc = metrics.auc_roc(s).select(F.lit("auc_roc").alias("metric"), F.col("auc_roc").alias("value"))
    pr = metrics.auc_pr(s).select(F.lit("auc_pr").alias("metric"), F.col("auc_pr").alias("value"))
    out = rows.unionByName(roc).unionByName(pr)
    return out.select("metric", rh(F.col("value"), 10).alias("value"))
