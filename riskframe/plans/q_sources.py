"""Sources, sinks and typed-record queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import dates, seeded
from riskframe.functions.numeric import sql_round_half_up as R
from riskframe.functions.numeric import round_half_up as rh
from riskframe.plans.catalog import query
from riskframe.plans.sizing import broadcast_if_small
from riskframe.session import scratch_path
from riskframe.sources import files
from riskframe.sources.tables import epoch_seconds_ntz, read_table, txn, with_txn

AS_OF = "2025-01-01"


@query("src_parquet", """
SELECT COUNT(*) AS n, MIN(value) AS min_value, MAX(value) AS max_value, MIN(ts) AS min_ts, MAX(ts) AS max_ts,
       COUNT(DISTINCT event_type) AS n_types
FROM events""")
def src_parquet(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    ev.createOrReplaceTempView("rf_events")
    return spark.sql("""
        SELECT COUNT(*) AS n, MIN(value) AS min_value, MAX(value) AS max_value, MIN(ts) AS min_ts,
               MAX(ts) AS max_ts, COUNT(DISTINCT event_type) AS n_types
        FROM rf_events""")


@query("src_partitioned_roundtrip", f"""
SELECT event_type, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, COUNT(*) AS n,
       {R('SUM(value)', 6)} AS total_value
FROM events GROUP BY event_type, year(ts), month(ts)""")
def src_partitioned_roundtrip(spark, sf_dir):
    """Write events partitioned by year/month/event_type, read all of it back by partition
    discovery and aggregate."""
    ev = read_table(spark, sf_dir, "events").withColumns(
        {"year": F.year("ts"), "month": F.month("ts")}
    )
    path = scratch_path(spark, "events_by_month")
    files.write_partitioned(ev, path, ["year", "month", "event_type"])
    back = files.read_partitioned(spark, path)
    return back.groupBy("event_type", "year", "month").agg(
        F.count(F.lit(1)).alias("n"), rh(F.sum("value"), 6).alias("total_value")
    ).select("event_type", F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"),
             "n", "total_value")


@query("src_csv_pipe", f"""
SELECT event_type, COUNT(*) AS n, {R('SUM(value)', 6)} AS total_value, MAX(event_id) AS max_event_id
FROM events GROUP BY event_type""")
def src_csv_pipe(spark, sf_dir):
    """Pipe-delimited CSV with header written and read back with an explicit schema."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    path = scratch_path(spark, "events_pipe_csv")
    files.write_delimited(ev, path, sep="|")
    back = files.read_delimited(spark, path, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE", sep="|")
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), rh(F.sum("value"), 6).alias("total_value"), F.max("event_id").alias("max_event_id")
    )


@query("from_csv_lines", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def from_csv_lines(spark, sf_dir):
    """Customer rows rendered as CSV lines, then parsed back to named, typed fields."""
    cust = read_table(spark, sf_dir, "customer")
    lines = cust.select(F.concat_ws(",", *[F.col(c).cast("string") for c in cust.columns]).alias("line"))
    return files.parse_csv_lines(
        lines, "line", "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    )


@query("src_range", f"""
SELECT CAST(i AS BIGINT) AS id, {seeded.sql_uniform('range', 'i')} AS u
FROM range((SELECT COUNT(*) FROM customer)) t(i)""")
def src_range(spark, sf_dir):
    """An id range source as long as the customer table, with a seeded draw per id."""
    n = read_table(spark, sf_dir, "customer").count()
    return spark.range(n).select(F.col("id"), seeded.uniform("range", "id").alias("u"))


SCORE_SQL_COLS = """event_id, is_fraud, CAST(CAST(amt >= 80 AS INTEGER) AS DOUBLE) AS prediction,
       LEAST(amt / 600.0, 1.0) AS fraud_probability"""


def _scores(spark, sf_dir):
    t = txn(spark, sf_dir)
    return t.select(
        "event_id", "is_fraud",
        (F.col("amt") >= 80).cast("int").cast("double").alias("prediction"),
        F.least(F.col("amt") / F.lit(600.0), F.lit(1.0)).alias("fraud_probability"),
    )


@query("sink_csv_roundtrip", with_txn(f"SELECT {SCORE_SQL_COLS} FROM txn"))
def sink_csv_roundtrip(spark, sf_dir):
    """Prediction columns written as CSV with header (overwrite) and read back."""
    path = scratch_path(spark, "predictions_csv")
    files.write_delimited(_scores(spark, sf_dir), path)
    return files.read_delimited(spark, path, "event_id BIGINT, is_fraud INT, prediction DOUBLE, fraud_probability DOUBLE")


@query("sink_vector_roundtrip", with_txn(
    f"SELECT event_id, is_fraud, prediction, fraud_probability AS p1 FROM (SELECT {SCORE_SQL_COLS} FROM txn)"))
def sink_vector_roundtrip(spark, sf_dir):
    """A vector column written to Parquet and read back."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    s = _scores(spark, sf_dir)
    vec = VectorAssembler(inputCols=["prediction", "fraud_probability"], outputCol="probability").transform(s)
    path = scratch_path(spark, "predictions_vec")
    vec.select("event_id", "is_fraud", "prediction", "probability").write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.select("event_id", "is_fraud", "prediction", F.get(vector_to_array("probability"), 1).alias("p1"))


@query("dim_from_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def dim_from_json(spark, sf_dir):
    """JSON text column -> typed struct field (``from_json`` with a schema)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("dim_merchants", with_txn("""
SELECT category, string_agg(merchant, '|' ORDER BY merchant) AS merchants, COUNT(*) AS n_merchants
FROM (SELECT DISTINCT category, merchant FROM txn) GROUP BY category"""))
def dim_merchants(spark, sf_dir):
    """Merchants per category as one sorted list. Distinct pairs are formed first (partial
    aggregation); the per-category list is bounded by the merchant naming rule (<= 100)."""
    pairs = txn(spark, sf_dir).select("category", "merchant").dropDuplicates()
    return pairs.groupBy("category").agg(
        F.array_join(F.sort_array(F.collect_list("merchant")), "|").alias("merchants"),
        F.count(F.lit(1)).alias("n_merchants"),
    )


@query("offset_limit", with_txn("SELECT event_id, customer_id, amt FROM txn ORDER BY event_id LIMIT 50 OFFSET 100"))
def offset_limit(spark, sf_dir):
    """Rows 101-150 in event order (a start/end offset window)."""
    return txn(spark, sf_dir).select("event_id", "customer_id", "amt").orderBy("event_id").offset(100).limit(50)


@query("typed_txn", f"""
SELECT event_id, md5('txn|' || CAST(event_id AS VARCHAR)) AS trans_num,
       strftime(ts, '%Y-%m-%d') AS trans_date, strftime(ts, '%H:%M:%S') AS trans_time,
       CAST(floor(epoch(ts)) AS BIGINT) AS unix_time,
       {R('value', 2)} AS amt,
       lpad(CAST({seeded.sql_h('acct', 'user_id')} AS VARCHAR), 12, '0') AS acct_num,
       CAST(user_id AS INTEGER) AS customer_id
FROM events""")
def typed_txn(spark, sf_dir):
    """Typed transaction record: md5 id, formatted date/time, epoch seconds, 2-decimal amount,
    12-digit account number."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.md5(F.concat(F.lit("txn|"), F.col("event_id").cast("string"))).alias("trans_num"),
        F.date_format("ts", "yyyy-MM-dd").alias("trans_date"),
        F.date_format("ts", "HH:mm:ss").alias("trans_time"),
        epoch_seconds_ntz("ts").alias("unix_time"),
        rh(F.col("value"), 2).alias("amt"),
        F.lpad(seeded.h("acct", "user_id").cast("string"), 12, "0").alias("acct_num"),
        F.col("user_id").cast("int").alias("customer_id"),
    )


# Hand-made malformed rows appended to the table-derived ones (fixed values).
BAD_ROWS = [("bad-1", "2023-02-30", "10:00:00", "12.5"), ("bad-2", "2023-01-31", "25:61:00", "3.0"),
            ("bad-3", "2023-01-31", "09:15:00", "abc"), ("bad-4", "not a date", "09:15:00", "-4.0")]


def _reject_input(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    text = ev.select(
        F.col("event_id").cast("string").alias("rec_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("d"),
        F.date_format("ts", "HH:mm:ss").alias("t"),
        F.col("value").cast("string").alias("a"),
    )
    bad = spark.createDataFrame(BAD_ROWS, "rec_id string, d string, t string, a string")
    return text.unionByName(bad)


@query("rejects", f"""
WITH src AS (
  SELECT CAST(event_id AS VARCHAR) AS rec_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S') AS t,
         CAST(value AS VARCHAR) AS a FROM events
  UNION ALL SELECT * FROM (VALUES {", ".join(str(r) for r in BAD_ROWS)}) v(rec_id, d, t, a)),
chk AS (SELECT rec_id,
          CASE WHEN try_strptime(d, '%Y-%m-%d') IS NULL THEN 'bad_date'
               WHEN try_strptime(t, '%H:%M:%S') IS NULL THEN 'bad_time'
               WHEN TRY_CAST(a AS DOUBLE) IS NULL THEN 'bad_amount'
               WHEN TRY_CAST(a AS DOUBLE) < 0 THEN 'negative_amount' END AS reason
        FROM src)
SELECT rec_id, reason FROM chk WHERE reason IS NOT NULL""")
def rejects(spark, sf_dir):
    """Rows failing typed parsing, each with the first failing rule (nothing is dropped silently)."""
    src = _reject_input(spark, sf_dir)
    amt = F.col("a").try_cast("double")
    reason = (
        F.when(F.try_to_date("d", "yyyy-MM-dd").isNull(), "bad_date")
        .when(F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.col("t")), F.lit("yyyy-MM-dd HH:mm:ss")).isNull(), "bad_time")
        .when(amt.isNull(), "bad_amount")
        .when(amt < 0, "negative_amount")
    )
    return src.select("rec_id", reason.alias("reason")).where(F.col("reason").isNotNull())


# Hand-made date texts appended to the customer birth dates (fixed values).
DATE_TEXTS = ["01-31-2023", "2023-01-31", "31/01/2023", "bad"]


@query("parse_dates", with_txn(f"""
SELECT customer_id, txt,
       COALESCE(CAST(try_strptime(txt, '%m-%d-%Y') AS DATE), CAST(try_strptime(txt, '%Y-%m-%d') AS DATE),
                CAST(try_strptime(txt, '%d/%m/%Y') AS DATE)) AS parsed
FROM (SELECT customer_id,
             CASE customer_id % 3 WHEN 0 THEN strftime(CAST(dob AS DATE), '%m-%d-%Y')
                                  WHEN 1 THEN dob
                                  ELSE strftime(CAST(dob AS DATE), '%d/%m/%Y') END AS txt
      FROM cust_dim
      UNION ALL SELECT * FROM (VALUES {", ".join(f"(-{i + 1}, '{t}')" for i, t in enumerate(DATE_TEXTS))}) v(customer_id, txt))"""))
def parse_dates(spark, sf_dir):
    """Birth dates written in three formats, parsed back by trying each format in turn."""
    from riskframe.sources.tables import customer_dim

    cd = customer_dim(spark, sf_dir)
    d = F.to_date("dob")
    txt = (F.when(F.col("customer_id") % 3 == 0, F.date_format(d, "MM-dd-yyyy"))
           .when(F.col("customer_id") % 3 == 1, F.col("dob"))
           .otherwise(F.date_format(d, "dd/MM/yyyy")))
    rows = cd.select("customer_id", txt.alias("txt"))
    extra = spark.createDataFrame([(-(i + 1), t) for i, t in enumerate(DATE_TEXTS)], "customer_id bigint, txt string")
    allr = rows.unionByName(extra)
    return allr.select("customer_id", "txt", dates.parse_date_multi("txt").alias("parsed"))


def _sql_is_leap(y):
    return f"(({y}) % 4 = 0 AND ({y}) % 100 <> 0 OR ({y}) % 400 = 0)"


@query("dob_from_age", (lambda: f"""
WITH a AS (SELECT c_custkey AS customer_id, 18 + {seeded.sql_h('age', 'c_custkey')} % 70 AS age,
                  DATE '2000-01-01' + CAST({seeded.sql_h('dob', 'c_custkey')} % 366 AS INTEGER) AS md1,
                  DATE '2001-01-01' + CAST({seeded.sql_h('dob2', 'c_custkey')} % 365 AS INTEGER) AS md2
           FROM customer),
b AS (SELECT *, year(DATE '{AS_OF}') - age - CASE WHEN 101 < month(md1) * 100 + day(md1) THEN 1 ELSE 0 END AS y1 FROM a),
c AS (SELECT customer_id, age,
             CASE WHEN month(md1) = 2 AND day(md1) = 29 AND NOT {_sql_is_leap('y1')} THEN md2 ELSE md1 END AS md FROM b)
SELECT customer_id, CAST(age AS BIGINT) AS age,
       make_date(CAST(year(DATE '{AS_OF}') - age - CASE WHEN 101 < month(md) * 100 + day(md) THEN 1 ELSE 0 END AS BIGINT),
                 month(md), day(md)) AS dob
FROM c""")())
def dob_from_age(spark, sf_dir):
    """Seeded age per customer, then a birth date consistent with that age on the as-of date."""
    cust = read_table(spark, sf_dir, "customer")
    age = (F.lit(18) + seeded.h("age", "c_custkey") % 70).cast("bigint")
    base = cust.select(F.col("c_custkey").alias("customer_id"), age.alias("age"))
    return dates.with_dob_from_age(base, "age", "customer_id", AS_OF).select("customer_id", "age", "dob")


LOOKUP_SQL = """
WITH nw AS (SELECT n.n_nationkey, n.n_name, r.r_name, COUNT(*) AS w
            FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
            GROUP BY n.n_nationkey, n.n_name, r.r_name)
SELECT CASE WHEN ROW_NUMBER() OVER (ORDER BY n_nationkey DESC) = 1 THEN 1.0
            ELSE CAST(SUM(w) OVER (ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
                 / CAST(SUM(w) OVER () AS DOUBLE) END AS cdf,
       n_name AS city, r_name AS state, CAST(n_nationkey AS VARCHAR) AS code, CAST(w AS VARCHAR) AS population
FROM nw"""


@query("lookup_csv_dim", LOOKUP_SQL)
def lookup_csv_dim(spark, sf_dir):
    """A delimited lookup file of the form ``cdf,city|state|code|population`` written from the
    data (customer shares per nation) and read back into a typed dim (split + element access)."""
    from riskframe.operators import assign

    cust = read_table(spark, sf_dir, "customer")
    geo = read_table(spark, sf_dir, "nation").join(read_table(spark, sf_dir, "region"),
                                                   F.col("n_regionkey") == F.col("r_regionkey"))
    w = cust.join(broadcast_if_small(geo, 10_000), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        "n_nationkey", "n_name", "r_name").agg(F.count(F.lit(1)).alias("w"))
    dim = assign.cdf_dim(w, "n_nationkey", "w")
    lines = dim.select(F.col("hi").alias("cdf"),
                       F.concat_ws("|", "n_name", "r_name", F.col("n_nationkey").cast("string"),
                                   F.col("w").cast("string")).alias("location"))
    path = scratch_path(spark, "locations_csv")
    files.write_delimited(lines, path)
    back = files.read_delimited(spark, path, "cdf DOUBLE, location STRING")
    parsed = files.split_lookup(back, "location", ["city", "state", "code", "population"])
    return parsed.select("cdf", "city", "state", "code", "population")
