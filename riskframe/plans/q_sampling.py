"""Seeded sampling queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskframe.functions import seeded
from riskframe.functions.numeric import round_half_up as rh
from riskframe.functions.numeric import sql_round_half_up as R
from riskframe.operators import sampling
from riskframe.plans.catalog import query
from riskframe.plans.q_assign import SEG_CTES, customer_segments
from riskframe.plans.sizing import broadcast_if_small
from riskframe.sources import dims
from riskframe.sources.tables import read_table, txn, with_txn

H, U = seeded.sql_h, seeded.sql_uniform


def _sql_randint(salt, key, lo, hi):
    return f"(({lo}) + {H(salt, key)} % (({hi}) - ({lo}) + 1))"


def _sql_randint_d(i, key, lo, hi, salt="time42"):
    return f"(({lo}) + {seeded.sql_draw(salt, key, i)} % (({hi}) - ({lo}) + 1))"


def _sql_u_d(i, key, salt="time42"):
    return f"(CAST({seeded.sql_draw(salt, key, i)} + 1 AS DOUBLE) / 4294967296.0)"


@query("split_train_test", with_txn(
    f"SELECT event_id, is_fraud, CASE WHEN {U('split42', 'event_id')} <= 0.8 THEN 'train' ELSE 'test' END AS split FROM txn"))
def split_train_test(spark, sf_dir):
    """80/20 split by a seeded draw of the event key (independent of partitioning)."""
    return sampling.hash_split(txn(spark, sf_dir).select("event_id", "is_fraud"), "event_id", 0.8, 42)


@query("fold_assign", with_txn(f"SELECT event_id, is_fraud, CAST({H('fold42', 'event_id')} % 3 AS INTEGER) AS fold FROM txn"))
def fold_assign(spark, sf_dir):
    return sampling.assign_folds(txn(spark, sf_dir).select("event_id", "is_fraud"), "event_id", 3, 42)


BALANCE_SQL = with_txn(f"""
SELECT event_id, is_fraud, CAST(unnest(generate_series(1, n)) AS INTEGER) AS copy FROM bx WHERE n > 0""",
    f"""bc AS (SELECT CAST(COALESCE(SUM(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n1,
              CAST(COALESCE(SUM(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n0 FROM txn),
br AS (SELECT CASE WHEN n1 > 0 AND CAST(n1 AS DOUBLE) / CAST(n1 + n0 AS DOUBLE) < CAST(0.1 AS DOUBLE)
                   THEN (CAST(0.3 AS DOUBLE) * CAST(n0 AS DOUBLE)) / (CAST(n1 AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(0.3 AS DOUBLE)))
              END AS r FROM bc),
bx AS (SELECT t.event_id, t.is_fraud,
              CASE WHEN br.r IS NULL OR t.is_fraud <> 1 THEN 1
                   ELSE CAST(floor(br.r) AS INTEGER) + CASE WHEN {U('over42', 't.event_id')} < br.r - floor(br.r) THEN 1 ELSE 0 END
              END AS n
       FROM txn t CROSS JOIN br)""")


@query("balance_oversample", BALANCE_SQL)
def balance_oversample(spark, sf_dir):
    """Minority rows repeated to a 30 % share (share under 10 % triggers it), majority once."""
    t = txn(spark, sf_dir).select("event_id", "is_fraud")
    return sampling.balance_oversample(t, "event_id", "is_fraud", target=0.3, trigger=0.1, seed=42)


@query("class_weights", with_txn("""
SELECT is_fraud, n, CAST(SUM(n) OVER () AS DOUBLE) / (CAST(COUNT(*) OVER () AS DOUBLE) * CAST(n AS DOUBLE)) AS weight
FROM (SELECT is_fraud, COUNT(*) AS n FROM txn GROUP BY is_fraud)"""))
def class_weights(spark, sf_dir):
    return sampling.class_weights(txn(spark, sf_dir))


@query("union_classes", with_txn("""
SELECT event_id, is_fraud, amt FROM txn WHERE is_fraud = 1
UNION ALL SELECT event_id, is_fraud, amt FROM txn WHERE is_fraud = 0"""))
def union_classes(spark, sf_dir):
    t = txn(spark, sf_dir).select("event_id", "is_fraud", "amt")
    return t.where(F.col("is_fraud") == 1).unionByName(t.where(F.col("is_fraud") == 0))


def _event_span(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.agg(F.min(F.to_date("ts")).alias("span_start"),
                  F.date_diff(F.max(F.to_date("ts")), F.min(F.to_date("ts"))).alias("span_days"))


SPAN_SQL = """span AS (SELECT MIN(CAST(ts AS DATE)) AS span_start,
                      date_diff('day', MIN(CAST(ts AS DATE)), MAX(CAST(ts AS DATE))) AS span_days FROM events)"""


def _ps_sql():
    rows = [f"('{p}', {s['avg_transactions_per_day']['min']}, {s['avg_transactions_per_day']['max']}, "
            f"{s['shopping_time']['AM']}, {s['shopping_time']['PM']})" for p, s in dims.DEFAULT_PROFILE_SETTINGS.items()]
    return "ps(profile, tx_min, tx_max, am_weight, pm_weight) AS (VALUES " + ", ".join(rows) + ")"


@query("expand_rows", with_txn(f"""
SELECT customer_id, profile, CAST(n_txn AS INTEGER) AS n_txn, CAST(unnest(generate_series(1, n_txn)) AS INTEGER) AS txn_no
FROM (SELECT s.customer_id, s.profile,
             span.span_days * {_sql_randint('ntx', 's.customer_id', 'p.tx_min', 'p.tx_max')} AS n_txn
      FROM seg s JOIN ps p ON p.profile = s.profile CROSS JOIN span)
WHERE n_txn > 0""", SEG_CTES + ",\n" + _ps_sql() + ",\n" + SPAN_SQL))
def expand_rows(spark, sf_dir):
    """Customer -> days x U{min..max} transactions of its profile, one row each."""
    seg = customer_segments(spark, sf_dir).select("customer_id", "profile")
    ps = dims.profile_settings(spark)
    base = seg.join(F.broadcast(ps), "profile").crossJoin(F.broadcast(_event_span(spark, sf_dir)))
    out = sampling.expand_rows(base, "customer_id", F.col("span_days"), F.col("tx_min"), F.col("tx_max"))
    return out.select("customer_id", "profile", "n_txn", "txn_no")


@query("fraud_window", with_txn(f"""
SELECT customer_id, fraud_customer,
       CASE WHEN fraud_customer = 1 THEN span_start + CAST(off AS INTEGER) END AS fraud_start,
       CASE WHEN fraud_customer = 1 THEN span_start + CAST(off AS INTEGER) + 1 END AS fraud_end
FROM (SELECT d.customer_id,
             CAST({U('fraudgate42', 'd.customer_id')} < CAST(99 AS DOUBLE) / CAST(101 AS DOUBLE) AS INTEGER) AS fraud_customer,
             {_sql_randint('fraudday42', 'd.customer_id', '1', 'greatest(span.span_days - 7, 1)')} AS off,
             span.span_start
      FROM cust_dim d CROSS JOIN span)""", SPAN_SQL))
def fraud_window(spark, sf_dir):
    """Per customer: seeded fraud gate (99 of 101) and a one-day fraud window inside the span."""
    from riskframe.sources.tables import customer_dim

    base = customer_dim(spark, sf_dir).select("customer_id").crossJoin(F.broadcast(_event_span(spark, sf_dir)))
    out = sampling.fraud_window(base, "customer_id", F.col("span_start"), F.col("span_days"), 99 / 101, 42)
    return out.select("customer_id", "fraud_customer", "fraud_start", "fraud_end")


@query("daypart_time", with_txn(f"""
SELECT event_id, daypart, CAST(hour AS BIGINT) AS hour, CAST(minute AS BIGINT) AS minute, CAST(second AS BIGINT) AS second,
       printf('%02d:%02d:%02d', hour, minute, second) AS trans_time
FROM (SELECT *, {_sql_randint_d(2, 'event_id', 'hr_lo', 'hr_hi')} AS hour,
             {_sql_randint_d(3, 'event_id', '0', '59')} AS minute,
             {_sql_randint_d(4, 'event_id', '0', '59')} AS second
      FROM (SELECT *, CASE WHEN daypart = 'AM' THEN 0 WHEN night THEN 22 ELSE 12 END AS hr_lo,
                      CASE WHEN daypart = 'AM' THEN (CASE WHEN night THEN 3 ELSE 11 END) ELSE 23 END AS hr_hi
            FROM (SELECT t.event_id,
                         CASE WHEN {_sql_u_d(0, 't.event_id')} <= CAST(p.am_weight AS DOUBLE) / CAST(p.am_weight + p.pm_weight AS DOUBLE)
                              THEN 'AM' ELSE 'PM' END AS daypart,
                         (t.is_fraud = 1 AND {_sql_randint_d(1, 't.event_id', '1', '100')} > 20) AS night
                  FROM txn t JOIN seg s ON s.customer_id = t.customer_id
                             JOIN ps p ON p.profile = (CASE WHEN t.is_fraud = 1 THEN 'fraud_' ELSE '' END) || s.profile)))""",
    SEG_CTES + ",\n" + _ps_sql()))
def daypart_time(spark, sf_dir):
    """Time of day per transaction from its profile's AM/PM weights (fraud rows use the
    ``fraud_`` profile and mostly night hours)."""
    seg = customer_segments(spark, sf_dir).select("customer_id", "profile")
    ps = dims.profile_settings(spark).select(F.col("profile").alias("pprofile"), "am_weight", "pm_weight")
    t = txn(spark, sf_dir).select("event_id", "customer_id", "is_fraud").join(seg, "customer_id")
    key = F.concat(F.when(F.col("is_fraud") == 1, F.lit("fraud_")).otherwise(F.lit("")), F.col("profile"))
    t = t.join(F.broadcast(ps), key == F.col("pprofile"))
    names = ["daypart", "night", "hour", "minute", "second"]
    t = seeded.with_uniforms(t, "time42", "event_id", [f"_u_{n}" for n in names])  # two md5 per row
    out = sampling.with_daypart_time(t, "event_id", F.col("am_weight"), F.col("pm_weight"), F.col("is_fraud"), 42,
                                     draws={n: F.col(f"_u_{n}") for n in names})
    return out.select("event_id", "daypart", "hour", "minute", "second", "trans_time")


@query("geo_jitter", with_txn(f"""
SELECT event_id, lat + (2.0 * {U('jlat', 'event_id')} - 1.0) * 1.0 AS merch_lat,
       long + (2.0 * {U('jlong', 'event_id')} - 1.0) * 1.0 AS merch_long
FROM txn"""))
def geo_jitter(spark, sf_dir):
    """Merchant location = customer location +- 1 degree (uniform per coordinate)."""
    t = txn(spark, sf_dir)
    return t.select(
        "event_id",
        sampling.geo_jitter(F.col("lat"), "event_id", "jlat").alias("merch_lat"),
        sampling.geo_jitter(F.col("long"), "event_id", "jlong").alias("merch_long"),
    )


@query("travel_jitter", with_txn(f"""
SELECT event_id, {R("lat + (2.0 * " + U('tlat', 'event_id') + " - 1.0) * radius", 9)} AS merch_lat,
       {R("long + (2.0 * " + U('tlong', 'event_id') + " - 1.0) * radius", 9)} AS merch_long
FROM (SELECT *, CASE WHEN is_fraud = 1 OR hour(CAST(trans_time AS TIME)) >= 20
                     THEN CAST(customer_id % 500 AS DOUBLE) / 100.0::DOUBLE * 1.43::DOUBLE ELSE 1.0::DOUBLE END AS radius FROM txn)"""))
def travel_jitter(spark, sf_dir):
    """Merchant location of customers of whom some travel (fraud or evening): their radius follows how far they may go."""
    t = txn(spark, sf_dir)
    away = (F.col("is_fraud") == 1) | (F.substring("trans_time", 1, 2).cast("int") >= 20)
    far = (F.col("customer_id") % 500).cast("double")
    return t.select("event_id", *[rh(sampling.geo_jitter(F.col(c), "event_id", f"t{c}", away, far), 9).alias(f"merch_{c}")
                                  for c in ("lat", "long")])


def _gamma_sql():
    """Marsaglia and Tsang's draw in SQL: the first accepted of the seeded attempts (twelve are enough for any table here)."""
    dg = "md5('gamma42|' || CAST(e.event_id AS VARCHAR) || '|' || CAST(i AS VARCHAR))"
    u = lambda j: f"((CAST(('0x' || substr({dg}, {1 + 8 * j}, 8)) AS BIGINT) + 1)::DOUBLE / 4294967296.0::DOUBLE)"
    return with_txn(f"""
SELECT event_id, category, {R("CASE WHEN x < 1.0 THEN 1.0 + 9.0 * " + U('gammalow42', 'event_id') + " ELSE x END", 2)} AS amount
FROM (SELECT event_id, category, arg_min(d * v, i) * any_value(boost) * any_value(scale) AS x
      FROM (SELECT *, pow(1.0::DOUBLE + z / sqrt(9.0::DOUBLE * d), 3) AS v
            FROM (SELECT e.event_id, e.category, g.scale, g.d, i, {u(2)} AS u,
                         sqrt(-2.0::DOUBLE * ln({u(0)})) * cos({2.0 * math.pi!r}::DOUBLE * {u(1)}) AS z,
                         CASE WHEN g.shape < 1 THEN pow({U('gamma42_boost', 'e.event_id')}, 1.0::DOUBLE / g.shape) ELSE 1.0::DOUBLE END AS boost
                  FROM txn e JOIN gd g ON g.category = e.category CROSS JOIN range(1, 13) s(i)))
      WHERE v > 0 AND ln(u) < 0.5::DOUBLE * z * z + d - d * v + d * ln(CASE WHEN v > 0 THEN v ELSE 1.0 END)
      GROUP BY event_id, category)""",
        f"""gm AS (SELECT category, {R('avg(amt)', 6)} AS m, {R('stddev_samp(amt)', 6)} AS s FROM txn GROUP BY category),
gs AS (SELECT category, m * m / (s * s) AS shape, s * s / m AS scale FROM gm),
gd AS (SELECT *, CASE WHEN shape < 1 THEN shape + 1.0::DOUBLE ELSE shape END - 1.0::DOUBLE / 3.0::DOUBLE AS d FROM gs)""")


@query("gamma_amounts", _gamma_sql())
def gamma_amounts(spark, sf_dir):
    """Per-transaction amount drawn from its category's gamma (moments from the data)."""
    t = txn(spark, sf_dir)
    specs = t.groupBy("category").agg(rh(F.avg("amt"), 6).alias("m"), rh(F.stddev_samp("amt"), 6).alias("s"))
    specs = specs.select("category", (F.col("m") * F.col("m") / (F.col("s") * F.col("s"))).alias("shape"),
                         (F.col("s") * F.col("s") / F.col("m")).alias("scale"))
    j = t.select("event_id", "category").join(broadcast_if_small(specs, 100_000), "category")
    out = sampling.with_gamma_amount(j, F.col("shape"), F.col("scale"), "event_id", "amount", 42)
    return out.select("event_id", "category", rh(F.col("amount"), 2).alias("amount"))


# ------------------------------------------------------------------ SMOTE

SMOTE_CTES = """m AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = 0),
nd AS (SELECT a.id, b.id AS nbr_id, list_distance(a.v, b.v) AS dist FROM m a JOIN m b ON a.id <> b.id),
nn AS (SELECT id, nbr_id, dist, ROW_NUMBER() OVER (PARTITION BY id ORDER BY dist, nbr_id) AS rank FROM nd)"""


@query("smote_knn", f"WITH {SMOTE_CTES}\nSELECT id, CAST(rank AS BIGINT) AS rank, nbr_id, {R('dist', 6)} AS dist "
                    "FROM nn WHERE rank <= 5")
def smote_knn(spark, sf_dir):
    """Exact 5 nearest neighbours inside the minority class (label 0) of ``embeddings``."""
    from riskframe.operators.knn import exact_knn

    emb = read_table(spark, sf_dir, "embeddings").where(F.col("label") == 0)
    nn = exact_knn(emb, "vec_id", "embedding", k=5)
    return nn.select("id", "rank", "nbr_id", rh(F.col("dist"), 6).alias("dist"))


def _smote_sql():
    key = seeded.sql_compound_key("id", "copy")
    return f"""WITH {SMOTE_CTES},
cnt AS (SELECT SUM(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS n_min, SUM(CASE WHEN label <> 0 THEN 1 ELSE 0 END) AS n_maj
        FROM embeddings),
pool AS (SELECT id, {H('bucket', 'id')} % 256 AS bk FROM m),
bc AS (SELECT bk, COUNT(*) AS c FROM pool GROUP BY bk),
bo AS (SELECT bk, SUM(c) OVER (ORDER BY bk) - c AS off FROM bc),
ix AS (SELECT p.id, bo.off + ROW_NUMBER() OVER (PARTITION BY p.bk ORDER BY p.id) AS i FROM pool p JOIN bo ON bo.bk = p.bk),
per AS (SELECT ix.id, cnt.n_min,
               CAST(floor(greatest(cnt.n_maj - cnt.n_min, 0) / cnt.n_min) AS BIGINT)
               + CASE WHEN ix.i <= greatest(cnt.n_maj - cnt.n_min, 0) % cnt.n_min THEN 1 ELSE 0 END AS c
        FROM ix CROSS JOIN cnt),
rws AS (SELECT id, n_min, unnest(generate_series(1, c)) AS copy FROM per WHERE c > 0),
picks AS (SELECT id, copy, {_sql_randint('smnb42', key, '1', 'least(5, n_min - 1)')} AS rank,
                 {U('smgap42', key)} AS gap FROM rws)
SELECT p.id AS base_id, CAST(p.copy AS BIGINT) AS copy, nn.nbr_id, p.gap,
       list_transform(list_zip(b.v, n.v), lambda z: {R('z[1] + p.gap * (z[2] - z[1])', 6)}) AS syn_vec
FROM picks p JOIN nn ON nn.id = p.id AND nn.rank = p.rank JOIN m b ON b.id = p.id JOIN m n ON n.id = nn.nbr_id"""


@query("smote_synthesize", _smote_sql())
def smote_synthesize(spark, sf_dir):
    """Synthetic label-0 rows up to parity with the other labels: x + u * (neighbour - x)."""
    from riskframe.operators.smote import smote

    emb = read_table(spark, sf_dir, "embeddings")
    return smote(emb, "vec_id", "embedding", "label", 0, k=5, seed=42, digits=6)


POISSON_SQL = with_txn(f"""
SELECT event_id, is_fraud, CAST(unnest(generate_series(1, n)) AS INTEGER) AS copy
FROM (SELECT t.event_id, t.is_fraud, CASE WHEN t.is_fraud <> 1 OR br.r IS NULL THEN 1
        ELSE (SELECT MIN(k) FROM pk WHERE cdf >= {U('over42', 't.event_id')}) END AS n
      FROM txn t CROSS JOIN br) WHERE n > 0""",
    """bc AS (SELECT CAST(COALESCE(SUM(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END), 0) AS DOUBLE) AS n1,
              CAST(COALESCE(SUM(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END), 0) AS DOUBLE) AS n0 FROM txn),
br AS (SELECT CASE WHEN n1 > 0 AND n1 / (n1 + n0) < CAST(0.1 AS DOUBLE)
                   THEN (CAST(0.3 AS DOUBLE) * n0) / (n1 * (CAST(1.0 AS DOUBLE) - CAST(0.3 AS DOUBLE))) END AS r FROM bc),
pk AS (SELECT k, SUM(exp(k * ln(r) - r - lgamma(k + 1))) OVER (ORDER BY k) AS cdf FROM br, range(0, 2000) s(k))""")


@query("balance_poisson", POISSON_SQL)
def balance_poisson(spark, sf_dir):
    """Poisson bootstrap of the minority (what ``sample(withReplacement=True)`` does), seeded
    by the event key so it does not change with partitioning."""
    t = txn(spark, sf_dir).select("event_id", "is_fraud")
    return sampling.balance_oversample(t, "event_id", "is_fraud", target=0.3, trigger=0.1, seed=42, method="poisson")
