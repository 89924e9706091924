"""Queries over written files: reject routing in batch and stream, globs of two schemas, inferred CSV, config and lookup files.

The files are written from the tables first; what makes a record bad is a hash of its key (stand-in for damaged input). The
readers and checks know nothing of that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import seeded
from riskframe.functions.numeric import round_half_up as rh
from riskframe.functions.numeric import sql_round_half_up as R
from riskframe.plans import detector
from riskframe.plans.catalog import query
from riskframe.session import scratch_path
from riskframe.sources import configs, files, rejects
from riskframe.sources.tables import customer_dim, read_table, txn, with_txn

H = seeded.sql_h

# ------------------------------------------------------------------ reject routing

#: Each damage: the name of the field, every how many records (by hash), the text put there. Stand-in values.
DAMAGE = (("d", 97, "2023-02-30"), ("t", 89, "25:61:00"), ("a", 83, "abc"), ("a", 101, "-4.0"), ("d", 211, None))


def raw_records(spark, sf_dir) -> DataFrame:
    """Events as text records, some of them damaged."""
    rows = read_table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("rec_id"), F.date_format("ts", "yyyy-MM-dd").alias("d"),
        F.date_format("ts", "HH:mm:ss").alias("t"), F.col("value").cast("string").alias("a"))
    for i, (name, every, text) in enumerate(DAMAGE):
        hit = seeded.h(f"damage{i}", "rec_id") % every == 0
        rows = rows.withColumn(name, F.when(hit, F.lit(text).cast("string")).otherwise(F.col(name)))
    return rows


def record_checks() -> rejects.Checks:
    amount = F.col("a").try_cast("double")
    time = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), F.col("t")), F.lit("yyyy-MM-dd HH:mm:ss"))
    return [("bad_date", F.try_to_date("d", "yyyy-MM-dd").isNull()), ("bad_time", time.isNull()),
            ("bad_amount", amount.isNull()), ("negative_amount", amount < 0)]


def _damaged_sql() -> str:
    sql = ("SELECT CAST(event_id AS VARCHAR) AS rec_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S') AS t, "
           "CAST(value AS VARCHAR) AS a FROM events")
    for i, (name, every, text) in enumerate(DAMAGE):
        value = "NULL" if text is None else f"'{text}'"
        sql = f"SELECT * REPLACE (CASE WHEN {H(f'damage{i}', 'rec_id')} % {every} = 0 THEN {value} ELSE {name} END AS {name}) FROM ({sql})"
    return sql


REJECTS_SQL = f"""
SELECT rec_id, d, t, CASE WHEN TRY_CAST(a AS DOUBLE) IS NULL THEN a ELSE 'number' END AS a, reasons FROM (
  SELECT *, array_to_string(list_filter([
      CASE WHEN try_strptime(d, '%Y-%m-%d') IS NULL THEN 'bad_date' END, CASE WHEN try_strptime(t, '%H:%M:%S') IS NULL THEN 'bad_time' END,
      CASE WHEN TRY_CAST(a AS DOUBLE) IS NULL THEN 'bad_amount' END, CASE WHEN TRY_CAST(a AS DOUBLE) < 0 THEN 'negative_amount' END],
    lambda x: x IS NOT NULL), ',') AS reasons FROM ({_damaged_sql()}))
WHERE reasons <> '' UNION ALL
SELECT 'rows', NULL, NULL, 'number', CAST(COUNT(*) AS VARCHAR) FROM events"""


def _shown(spark, path: str, rows: int) -> DataFrame:
    """The reject table (numbers are not compared as text), and a row with the number of all rows."""
    bad = rejects.read_rejects(spark, path)
    number = F.when(F.col("a").try_cast("double").isNull(), F.col("a")).otherwise(F.lit("number"))
    total = spark.createDataFrame([("rows", None, None, "number", str(rows))], "rec_id string, d string, t string, a string, reasons string")
    return bad.select("rec_id", "d", "t", number.alias("a"), F.array_join("reasons", ",").alias("reasons")).unionByName(total)


@query("reject_routing", REJECTS_SQL)
def reject_routing(spark, sf_dir):
    """Text records to a good and a reject table in one pass; the rejects with all their reasons."""
    path = scratch_path(spark, "routed")
    counts = rejects.write_routed(raw_records(spark, sf_dir), record_checks(), path)
    return _shown(spark, path, counts["rows"])


@query("reject_routing_stream", REJECTS_SQL)
def reject_routing_stream(spark, sf_dir):
    """The same records arriving as files: the stream writes the same two tables."""
    source, path = scratch_path(spark, "arriving"), scratch_path(spark, "routed")
    raw = raw_records(spark, sf_dir)
    raw.write.parquet(source)
    stream = spark.readStream.schema(raw.schema).parquet(source)
    rejects.start_routed(stream, record_checks(), path, scratch_path(spark, "routed-progress")).awaitTermination()
    return _shown(spark, path, spark.read.parquet(path).count())


def _lacking(t: DataFrame) -> DataFrame:
    """Transactions of which some lack an amount, a zip code in digits or a place."""
    hit = lambda salt, every: seeded.h(salt, "event_id") % every == 0
    return t.withColumns({"amt": F.when(~hit("lack0", 89), F.col("amt")), "zip": F.when(hit("lack1", 83), "n/a").otherwise(F.col("zip")),
                          "lat": F.when(hit("lack2", 97), F.lit(float("nan"))).otherwise(F.col("lat"))})


@query("feature_rejects", with_txn(f"""
SELECT event_id, is_fraud, array_to_string(list_concat(CASE WHEN noamt THEN ['amt', 'log_amt'] ELSE [] END,
         CASE WHEN nozip THEN ['zip_numeric'] ELSE [] END, CASE WHEN nolat THEN ['lat', 'distance'] ELSE [] END), ',') AS missing
FROM (SELECT event_id, is_fraud, {H('lack0', 'event_id')} % 89 = 0 AS noamt, {H('lack1', 'event_id')} % 83 = 0 AS nozip,
             {H('lack2', 'event_id')} % 97 = 0 AS nolat FROM txn) WHERE noamt OR nozip OR nolat"""))
def feature_rejects(spark, sf_dir):
    """Transactions that the detector can't use, with the features they lack."""
    cfg = detector.DetectorConfig()
    bad = detector.rejected(detector.model_frame(_lacking(txn(spark, sf_dir)), cfg), cfg)
    return bad.select("event_id", "is_fraud", F.array_join("missing", ",").alias("missing"))


# ------------------------------------------------------------------ globs and schemas (A2, A3), inferred CSV (A4)

@query("src_glob_union", f"""
SELECT CAST(day(ts) AS BIGINT) AS day, COUNT(*) AS n, {R('SUM(value)', 4)} AS total_value, CAST(SUM(user_id) AS BIGINT) AS users,
       COUNT(CASE WHEN day(ts) > 15 THEN event_type END) AS n_types
FROM events GROUP BY day(ts)""")
def src_glob_union(spark, sf_dir):
    """Two generations of a table (the later one with wider types and a further column), read through globs of their day folders."""
    ev = read_table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    base = scratch_path(spark, "generations")
    old = ev.where("day <= 15").select("event_id", F.col("user_id").cast("int").alias("user_id"), "value", "day")
    new = ev.where("day > 15").select("event_id", F.col("user_id").cast("bigint").alias("user_id"), "value", "event_type", "day")
    files.write_partitioned(old, f"{base}/gen=1", ["day"])
    files.write_partitioned(new, f"{base}/gen=2", ["day"])
    present = [g for g, part in ((1, old), (2, new)) if not part.isEmpty()]
    back = files.read_globs(spark, [f"{base}/gen={g}/day=*" for g in present], base)
    if "event_type" not in back.columns:
        back = back.withColumn("event_type", F.lit(None).cast("string"))
    return back.groupBy(F.col("day").cast("bigint").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), rh(F.sum("value"), 4).alias("total_value"), F.sum("user_id").cast("bigint").alias("users"),
        F.count("event_type").alias("n_types"))


@query("src_csv_inferred", f"""
SELECT event_type, COUNT(*) AS n, {R('SUM(value)', 4)} AS total_value, CAST(SUM(event_id) AS BIGINT) AS ids, MIN(ts) AS first_ts,
       MAX(CAST(ts AS DATE)) AS last_day, CAST(0 AS BIGINT) AS misfits, 'int,timestamp_ntz,string,double,date' AS types
FROM events GROUP BY event_type""")
def src_csv_inferred(spark, sf_dir):
    """Pipe-delimited files without a schema: types inferred from a sample, one typed read, lines that don't fit counted."""
    ev = read_table(spark, sf_dir, "events")
    path = scratch_path(spark, "inferred")
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts")
    files.write_delimited(ev.select("event_id", ts, "event_type", "value", F.to_date("ts").alias("day")), path, sep="|")
    back = files.read_inferred(spark, path, sep="|", sampling_ratio=0.2)
    types = ",".join(f.dataType.simpleString() for f in back.schema[:-1]).replace("bigint", "int").replace("timestamp,", "timestamp_ntz,")
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), rh(F.sum("value"), 4).alias("total_value"), F.sum("event_id").cast("bigint").alias("ids"),
        F.min("ts").cast("timestamp_ntz").alias("first_ts"), F.max("day").alias("last_day"),
        F.count("_corrupt_record").alias("misfits"), F.lit(types).alias("types"))


# ------------------------------------------------------------------ config and lookup files

@query("config_files", """
WITH s AS (SELECT c_mktsegment AS profile, CAST(MIN(c_nationkey) AS INTEGER) AS tx_min, CAST(MAX(c_nationkey) AS INTEGER) AS tx_max,
                  CAST(COUNT(CASE WHEN c_custkey % 2 = 0 THEN 1 END) AS INTEGER) AS am_weight,
                  CAST(COUNT(CASE WHEN c_custkey % 2 = 1 THEN 1 END) AS INTEGER) AS pm_weight FROM customer GROUP BY 1),
r AS (SELECT profile, CAST(row_number() OVER (ORDER BY profile) AS INTEGER) AS prio, CAST(tx_min AS DOUBLE) AS age_min,
             CASE WHEN prio_odd THEN NULL ELSE CAST(tx_max AS DOUBLE) END AS age_max
      FROM (SELECT *, row_number() OVER (ORDER BY profile) % 2 = 1 AS prio_odd FROM s))
SELECT s.profile, tx_min, tx_max, am_weight, pm_weight, prio, age_min, age_max, CAST(1 AS BIGINT) AS n_corrupt
FROM s JOIN r USING (profile)""")
def config_files(spark, sf_dir):
    """Settings and segment rules per market segment, written as JSON documents over several lines and read back as tables;
    a cut-off document among them is reported."""
    pretty = {"pretty": "true", "ignoreNullFields": "false"}
    c = read_table(spark, sf_dir, "customer")
    per = c.groupBy(F.col("c_mktsegment").alias("profile")).agg(
        F.min("c_nationkey").cast("int").alias("lo"), F.max("c_nationkey").cast("int").alias("hi"),
        F.sum((F.col("c_custkey") % 2 == 0).cast("int")).alias("am"), F.sum((F.col("c_custkey") % 2 == 1).cast("int")).alias("pm"))
    settings = F.struct(F.struct(F.col("lo").alias("min"), F.col("hi").alias("max")).alias("avg_transactions_per_day"),
                        F.struct(F.col("am").alias("AM"), F.col("pm").alias("PM")).alias("shopping_time"))
    span = lambda lo, hi: F.struct(lo.cast("double").alias("min"), hi.cast("double").alias("max"))
    ranked = per.agg(F.array_sort(F.collect_list(F.struct("profile", "lo", "hi"))).alias("p"))  # a row of market segments
    rule = F.transform("p", lambda x, i: F.struct(x["profile"], F.struct(
        F.array(F.lit("F"), F.lit("M")).alias("gender"), span(x["lo"], F.when(i % 2 == 0, -1).otherwise(x["hi"])).alias("age"),
        span(F.lit(0), F.lit(-1)).alias("city_pop"))))
    doc = per.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("profile", settings)))), pretty).alias("value"))
    rules = ranked.select(F.to_json(F.map_from_entries(rule), pretty).alias("value"))
    path, rule_path = scratch_path(spark, "settings"), scratch_path(spark, "rules")
    doc.coalesce(1).write.text(path)
    doc.select(F.substring("value", F.lit(1), F.floor(F.length("value") / 2).cast("int"))).coalesce(1).write.mode("append").text(path)
    rules.coalesce(1).write.text(rule_path)
    corrupt = configs.json_documents(spark, path, configs.SETTINGS).agg(F.count("_corrupt_record").alias("n_corrupt"))
    joined = configs.read_profile_settings(spark, path).join(
        configs.read_segment_rules(spark, rule_path).select("profile", "prio", "age_min", "age_max"), "profile")
    return joined.crossJoin(F.broadcast(corrupt)).select(
        "profile", "tx_min", "tx_max", "am_weight", "pm_weight", "prio", "age_min", "age_max", "n_corrupt")


@query("demographics_file", with_txn(f"""
SELECT gender, CAST(age AS DOUBLE) AS age, {R('CAST(before AS DOUBLE) / total', 9)} AS lo, {R('CAST(before + n AS DOUBLE) / total', 9)} AS hi
FROM (SELECT *, SUM(n) OVER (ORDER BY gender, age) - n AS before, CAST(SUM(n) OVER () AS DOUBLE) AS total
      FROM (SELECT gender, 2025 - year(CAST(dob AS DATE)) AS age, COUNT(*) AS n FROM cust_dim GROUP BY 1, 2))"""))
def demographics_file(spark, sf_dir):
    """A demographics file ``group,age,gender,share`` of the customers, read back and cumulated in line order."""
    people = customer_dim(spark, sf_dir).groupBy("gender", (F.lit(2025) - F.year(F.to_date("dob"))).alias("age")).agg(
        F.count(F.lit(1)).alias("n"))
    total = people.agg(F.sum("n").alias("total"))
    share = (F.col("n").cast("double") / F.col("total").cast("double")).alias("share")
    lines = people.crossJoin(F.broadcast(total)).select(F.concat_ws("-", "gender", "age").alias("group"), "age", "gender", share)
    path = scratch_path(spark, "age_gender")
    files.write_delimited(lines.orderBy("gender", "age").coalesce(1), path)
    back = configs.read_age_gender(spark, path)
    return back.select("gender", "age", rh(F.col("lo"), 9).alias("lo"), rh(F.col("hi"), 9).alias("hi"))


@query("merchants_file", with_txn("""
SELECT category, COUNT(*) AS n, MIN(merchant) AS first_merchant, MAX(merchant) AS last_merchant
FROM (SELECT DISTINCT category, merchant FROM txn) GROUP BY category"""))
def merchants_file(spark, sf_dir):
    """A merchants file ``category|merchant`` written from the transactions and read back."""
    path = scratch_path(spark, "merchants")
    files.write_delimited(txn(spark, sf_dir).select("category", "merchant").distinct(), path, sep="|")
    return configs.read_merchants(spark, path).groupBy("category").agg(
        F.count("merchant").alias("n"), F.min("merchant").alias("first_merchant"), F.max("merchant").alias("last_merchant"))
