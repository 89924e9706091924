"""Encoding, scaling and moment queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskframe.functions import seeded
from riskframe.functions.numeric import round_half_up as rh
from riskframe.functions.numeric import round_sig
from riskframe.functions.numeric import sql_round_half_up as R
from riskframe.functions.numeric import sql_round_sig as RS
from riskframe.operators import encode, sampling
from riskframe.operators.features import detector_features
from riskframe.plans import prototype
from riskframe.plans.catalog import query
from riskframe.sources.tables import txn, with_txn

CATEGORICAL = ["category", "amt_range", "gender"]
SCALE_COLS = ["amt", "log_amt", "lat", "long", "city_pop", "distance", "hour"]
COV_COLS = ["amt", "log_amt", "lat", "long", "age", "hour", "distance"]
AS_OF = "2025-01-01"

FEAT_CTE = f"""feat AS (
  SELECT event_id, category, amt, ln(1 + amt) AS log_amt, lat, long, city_pop,
         CAST(date_diff('day', CAST(dob AS DATE), DATE '{AS_OF}') AS DOUBLE) / 365.25 AS age,
         CAST(hour(try_strptime(trans_date || ' ' || trans_time, '%Y-%m-%d %H:%M:%S')) AS DOUBLE) AS hour,
         sqrt(pow(lat - merch_lat, 2) + pow(long - merch_long, 2)) AS distance,
         CASE WHEN amt < 50 THEN 'low' WHEN amt < 200 THEN 'medium' WHEN amt < 500 THEN 'high' ELSE 'very_high' END AS amt_range,
         gender, is_fraud,
         CASE WHEN {seeded.sql_uniform('split42', 'event_id')} <= 0.8 THEN 'train' ELSE 'test' END AS split
  FROM txn)"""


def features_split(spark, sf_dir):
    f = detector_features(txn(spark, sf_dir), as_of=AS_OF)
    f = f.withColumn("hour", F.col("hour").cast("double"))
    return sampling.hash_split(f, "event_id", 0.8, 42)


def _idx_sql(col):
    return (f"SELECT value, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, value) - 1 AS BIGINT) AS idx "
            f"FROM (SELECT {col} AS value, COUNT(*) AS n FROM feat WHERE {col} IS NOT NULL GROUP BY {col})")


STRING_INDEX_SQL = with_txn(f"""
SELECT f.event_id, CAST(a.idx AS DOUBLE) AS category_idx, CAST(b.idx AS DOUBLE) AS amt_range_idx,
       CAST(c.idx AS DOUBLE) AS gender_idx
FROM feat f JOIN ({_idx_sql('category')}) a ON a.value = f.category
            JOIN ({_idx_sql('amt_range')}) b ON b.value = f.amt_range
            JOIN ({_idx_sql('gender')}) c ON c.value = f.gender""", FEAT_CTE)


@query("string_index", STRING_INDEX_SQL)
def string_index(spark, sf_dir):
    """StringIndexer (frequency desc, ties alphabetical, unseen kept) on the three categoricals."""
    f = features_split(spark, sf_dir)
    model = Pipeline(stages=encode.string_indexers(CATEGORICAL)).fit(f)
    return model.transform(f).select("event_id", *[f"{c}_idx" for c in CATEGORICAL])


@query("string_index_table", with_txn(f"""
SELECT 'category' AS col, value, idx FROM ({_idx_sql('category')})
UNION ALL SELECT 'amt_range', value, idx FROM ({_idx_sql('amt_range')})
UNION ALL SELECT 'gender', value, idx FROM ({_idx_sql('gender')})""", FEAT_CTE))
def string_index_table(spark, sf_dir):
    """The label -> index tables as plain aggregates (SQL twin of the indexer)."""
    f = features_split(spark, sf_dir)
    parts = [encode.index_table(f, c).select(F.lit(c).alias("col"), "value", "idx") for c in CATEGORICAL]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("one_hot", with_txn(f"""
SELECT f.event_id, CAST(s.slot AS BIGINT) AS slot, CAST(CASE WHEN a.idx = s.slot THEN 1.0 ELSE 0.0 END AS DOUBLE) AS value
FROM feat f JOIN ({_idx_sql('category')}) a ON a.value = f.category
CROSS JOIN (SELECT CAST(idx AS BIGINT) AS slot FROM ({_idx_sql('category')})) s""", FEAT_CTE))
def one_hot(spark, sf_dir):
    """One-hot of the category index: n categories -> n slots (the dropped slot is 'unseen')."""
    f = features_split(spark, sf_dir)
    stages = encode.string_indexers(["category"]) + encode.one_hot_encoders(["category"])
    enc = Pipeline(stages=stages).fit(f).transform(f)
    return encode.one_hot_long(enc, "event_id", "category_encoded")


@query("dummies_aligned", with_txn("""
SELECT r.event_id, r.split, 'category_' || k.c AS dummy,
       CAST(CASE WHEN r.category = k.c AND r.category <> fs.first THEN 1 ELSE 0 END AS BIGINT) AS value
FROM feat r JOIN fs ON fs.split = r.split
CROSS JOIN (SELECT DISTINCT c.category AS c FROM (SELECT DISTINCT split, category FROM feat) c
            JOIN fs ON fs.split = c.split WHERE c.category <> fs.first) k""",
    FEAT_CTE + ",\nfs AS (SELECT split, MIN(category) AS first FROM feat GROUP BY split)"))
def dummies_aligned(spark, sf_dir):
    """Drop-first dummies per split, aligned to the union of both splits' columns (0 fill)."""
    f = features_split(spark, sf_dir)
    return encode.aligned_dummies(f, "event_id", "category", "split")


def _scale_sql():
    std = ", ".join(f"stddev_samp({c}) AS {c}_sd" for c in SCALE_COLS)
    cols = ", ".join(f"{R(f'{c} / sd.{c}_sd', 6)} AS {c}_s" for c in SCALE_COLS)
    return with_txn(f"SELECT f.event_id, f.split, {cols} FROM feat f CROSS JOIN sd",
                    FEAT_CTE + f",\nsd AS (SELECT {std} FROM feat WHERE split = 'train')")


@query("scaled_features", _scale_sql())
def scaled_features(spark, sf_dir):
    """Unit-std scaling (no centring) fit on the train split only, applied to both splits."""
    f = features_split(spark, sf_dir)
    model = encode.fit_scaler(f.where(F.col("split") == "train"), SCALE_COLS)
    out = encode.scaled_columns(model, f, ["event_id", "split"], SCALE_COLS)
    return out.select("event_id", "split", *[rh(F.col(f"{c}_s"), 6).alias(f"{c}_s") for c in SCALE_COLS])


def _stats_sql():
    parts = [f"SELECT '{c}' AS feature, {RS(f'avg({c})', 10)} AS mean, {RS(f'stddev_samp({c})', 10)} AS std "
             f"FROM feat WHERE split = 'train'" for c in SCALE_COLS]
    return with_txn("\nUNION ALL ".join(parts), FEAT_CTE)


@query("scaler_stats", _stats_sql())
def scaler_stats(spark, sf_dir):
    """Per-feature mean and sample std on the train split (one aggregate pass, unpivoted)."""
    f = features_split(spark, sf_dir).where(F.col("split") == "train")
    aggs = []
    for c in SCALE_COLS:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    row = f.agg(*aggs)
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in SCALE_COLS])).alias("s")).select("s.*")
    return stacked.select("feature", round_sig("mean", 10).alias("mean"), round_sig("std", 10).alias("std"))


def _cov_pairs():
    return [(i, j) for i in range(len(COV_COLS)) for j in range(i, len(COV_COLS))]


def _cov_sql():
    parts = [f"SELECT CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, '{COV_COLS[i]}' AS fi, '{COV_COLS[j]}' AS fj, "
             f"{RS(f'covar_samp({COV_COLS[i]}, {COV_COLS[j]})', 10)} AS cov FROM feat" for i, j in _cov_pairs()]
    return with_txn("\nUNION ALL ".join(parts), FEAT_CTE)


@query("cov_matrix", _cov_sql())
def cov_matrix(spark, sf_dir):
    """Sample covariance of the numeric features, upper triangle in long form (one pass)."""
    f = features_split(spark, sf_dir)
    row = f.agg(*[F.covar_samp(COV_COLS[i], COV_COLS[j]).alias(f"c_{i}_{j}") for i, j in _cov_pairs()])
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j"), F.lit(COV_COLS[i]).alias("fi"),
                 F.lit(COV_COLS[j]).alias("fj"), F.col(f"c_{i}_{j}").alias("cov"))
        for i, j in _cov_pairs()])).alias("s")).select("s.*")
    return stacked.select("i", "j", "fi", "fj", round_sig("cov", 10).alias("cov"))


# fixed values: the prototype's numeric inputs
PROTO_NUMERIC = prototype.NUMERIC


def _centred_sql():
    raw = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PROTO_NUMERIC)
    moments = ", ".join(f"AVG({c}) AS {c}_m, COALESCE(NULLIF(stddev_pop({c}), 0), 1) AS {c}_s" for c in PROTO_NUMERIC)
    cols = ", ".join(f"{R(f'(p.{c} - m.{c}_m) / m.{c}_s', 6)} AS {c}_z" for c in PROTO_NUMERIC)
    return with_txn(f"SELECT p.event_id, p.split, {cols} FROM proto p CROSS JOIN m", f"""proto AS (
  SELECT event_id, CASE WHEN {seeded.sql_uniform('split42', 'event_id')} <= 0.8 THEN 'train' ELSE 'test' END AS split, {raw}
  FROM (SELECT *, year(DATE '2025-01-01') - year(CAST(dob AS DATE)) AS age, hour(tdt) AS hour, isodow(tdt) - 1 AS day, month(tdt) AS month
        FROM (SELECT DISTINCT *, try_strptime(trans_date || ' ' || trans_time, '%Y-%m-%d %H:%M:%S') AS tdt FROM txn))),
m AS (SELECT {moments} FROM proto WHERE split = 'train')""")


@query("prototype_centred", _centred_sql())
def prototype_centred(spark, sf_dir):
    """Centred scaling (mean and population deviation of the train split) of the prototype's numeric inputs, zip as a number."""
    rows, names = prototype.inputs(prototype.frame(txn(spark, sf_dir), prototype.PrototypeConfig()))
    z = prototype.centred(rows, len(names))
    return z.select("event_id", "split", *[rh(F.get("z", F.lit(i)), 6).alias(f"{c}_z") for i, c in enumerate(PROTO_NUMERIC)])
