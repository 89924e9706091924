"""Driver tables and the ``txn`` transaction view built from them.

``txn`` is the 21-column transaction fact the detector works on, derived from
``events`` x ``customer`` x ``nation`` x ``region``:

* the customer-level columns (location, zip, population, birth date, gender) are computed
  once per customer *before* the join, so hashing work scales with customers, not events;
* nation x region (fixed 25 x 5 rows in this schema) is broadcast behind a size check;
* events x customer is a shuffle join on the customer key. A hot customer holding a large
  share of events is split by AQE's skew-join handling (the events side is the streamed,
  splittable side of the inner join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.seeded import digest, quarter, sql_quarter
from riskframe.plans.sizing import broadcast_if_small
from riskframe.session import sf_path

# The column names of a transaction file.
TXN_COLUMNS = [
    "event_id", "customer_id", "trans_num", "trans_date", "trans_time", "unix_time", "category",
    "amt", "is_fraud", "merchant", "merch_lat", "merch_long", "gender", "city", "state", "zip",
    "lat", "long", "city_pop", "job", "dob",
]

# Fixed rule values of the view (documented in SURVEY 7.3).
FRAUD_MIN_AMOUNT = 60.0
FRAUD_NIGHT_START = 22  # hour >= 22 or hour < 4 counts as night
FRAUD_NIGHT_END = 4
DOB_EPOCH = "1930-01-01"
DOB_SPAN_DAYS = 27000


def session_memo(spark: SparkSession, key, build):
    """Reuse one logical plan per session and key (DataFrames are immutable plans; this only
    saves re-reading Parquet footers and re-analysing the same expressions)."""
    memo = spark.__dict__.setdefault("_riskframe_memo", {})
    if key not in memo:
        memo[key] = build()
    return memo[key]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = sf_path(sf_dir, name)
    return session_memo(spark, ("parquet", path), lambda: spark.read.parquet(path))


def epoch_seconds_ntz(ts) -> F.Column:
    """Epoch seconds of a TIMESTAMP_NTZ without any session time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (
        F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86400)
        + F.hour(c).cast("bigint") * F.lit(3600)
        + F.minute(c).cast("bigint") * F.lit(60)
        + F.floor(F.second(c)).cast("bigint")
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer columns of ``txn`` keyed by ``customer_id`` (one row per customer)."""
    return session_memo(spark, ("customer_dim", sf_dir), lambda: _customer_dim(spark, sf_dir))


def _customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = (
        read_table(spark, sf_dir, "nation")
        .join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    c = F.col("c_custkey")
    # one md5 per customer, four 32-bit hashes from it: latitude, longitude, population, birth day
    cust = cust.withColumn("_cd", digest("cust", c))
    return cust.join(broadcast_if_small(geo, 10_000), F.col("c_nationkey") == F.col("n_nationkey")).select(
        c.alias("customer_id"),
        F.when(c % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(((c * F.lit(7919)) % F.lit(100000)).cast("string"), 5, "0").alias("zip"),
        (F.lit(25.0) + (quarter("_cd", 0) % F.lit(24000)).cast("double") / F.lit(1000.0)).alias("lat"),
        (F.lit(-124.0) + (quarter("_cd", 1) % F.lit(57000)).cast("double") / F.lit(1000.0)).alias("long"),
        (F.lit(100) + quarter("_cd", 2) % F.lit(2000000)).alias("city_pop"),
        F.col("c_mktsegment").alias("job"),
        F.date_format(
            F.date_add(F.lit(DOB_EPOCH).cast("date"), (quarter("_cd", 3) % F.lit(DOB_SPAN_DAYS)).cast("int")),
            "yyyy-MM-dd",
        ).alias("dob"),
    )


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21-column transaction view (one row per event)."""
    return session_memo(spark, ("txn", sf_dir), lambda: _txn(spark, sf_dir))


def _txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cust = customer_dim(spark, sf_dir)
    e = F.col("event_id")
    hr = F.hour("ts")
    # one md5 per event, two 32-bit hashes from it: merchant latitude and longitude offsets
    joined = ev.join(cust, F.col("user_id") == F.col("customer_id")).withColumn("_ed", digest("ev", e))
    return joined.select(
        e,
        F.col("customer_id"),
        F.md5(F.concat(F.lit("t|"), e.cast("string"))).alias("trans_num"),
        F.date_format("ts", "yyyy-MM-dd").alias("trans_date"),
        F.date_format("ts", "HH:mm:ss").alias("trans_time"),
        epoch_seconds_ntz("ts").alias("unix_time"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amt"),
        (
            (F.col("value") >= F.lit(FRAUD_MIN_AMOUNT))
            & ((hr < F.lit(FRAUD_NIGHT_END)) | (hr >= F.lit(FRAUD_NIGHT_START)))
        ).cast("int").alias("is_fraud"),
        F.concat(F.lit("merchant_"), (e % F.lit(100)).cast("string")).alias("merchant"),
        (F.col("lat") + ((quarter("_ed", 0) % F.lit(2000001)) - F.lit(1000000)).cast("double")
         / F.lit(1000000.0)).alias("merch_lat"),
        (F.col("long") + ((quarter("_ed", 1) % F.lit(2000001)) - F.lit(1000000)).cast("double")
         / F.lit(1000000.0)).alias("merch_long"),
        "gender", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob",
    )


# ---------------------------------------------------------------- DuckDB twin of the view

def _d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


TXN_SQL = f"""
cust_dim AS (
  SELECT c.c_custkey AS customer_id,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         n.n_name AS city, r.r_name AS state,
         lpad(CAST((c.c_custkey * 7919) % 100000 AS VARCHAR), 5, '0') AS zip,
         CAST(25.0 AS DOUBLE) + {_d(sql_quarter('cust', 'c.c_custkey', 0) + ' % 24000')} / CAST(1000.0 AS DOUBLE) AS lat,
         CAST(-124.0 AS DOUBLE) + {_d(sql_quarter('cust', 'c.c_custkey', 1) + ' % 57000')} / CAST(1000.0 AS DOUBLE) AS long,
         100 + {sql_quarter('cust', 'c.c_custkey', 2)} % 2000000 AS city_pop,
         c.c_mktsegment AS job,
         strftime(DATE '{DOB_EPOCH}' + CAST({sql_quarter('cust', 'c.c_custkey', 3)} % {DOB_SPAN_DAYS} AS INTEGER), '%Y-%m-%d') AS dob
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey
),
txn AS (
  SELECT e.event_id, d.customer_id,
         md5('t|' || CAST(e.event_id AS VARCHAR)) AS trans_num,
         strftime(e.ts, '%Y-%m-%d') AS trans_date,
         strftime(e.ts, '%H:%M:%S') AS trans_time,
         CAST(floor(epoch(e.ts)) AS BIGINT) AS unix_time,
         e.event_type AS category,
         e.value AS amt,
         CAST((e.value >= {FRAUD_MIN_AMOUNT} AND (hour(e.ts) < {FRAUD_NIGHT_END} OR hour(e.ts) >= {FRAUD_NIGHT_START})) AS INTEGER) AS is_fraud,
         'merchant_' || CAST(e.event_id % 100 AS VARCHAR) AS merchant,
         d.lat + {_d('(' + sql_quarter('ev', 'e.event_id', 0) + ' % 2000001) - 1000000')} / CAST(1000000.0 AS DOUBLE) AS merch_lat,
         d.long + {_d('(' + sql_quarter('ev', 'e.event_id', 1) + ' % 2000001) - 1000000')} / CAST(1000000.0 AS DOUBLE) AS merch_long,
         d.gender, d.city, d.state, d.zip, d.lat, d.long, d.city_pop, d.job, d.dob
  FROM events e JOIN cust_dim d ON e.user_id = d.customer_id
)"""


def with_txn(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix a DuckDB query with the ``txn`` CTE (and optional extra CTEs)."""
    ctes = TXN_SQL + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{sql_body}"
