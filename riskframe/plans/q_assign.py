"""Assignment joins, enrichment and calendar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import seeded
from riskframe.functions.numeric import round_half_up as rh
from riskframe.functions.numeric import sql_round_half_up as R
from riskframe.operators import assign, calendar
from riskframe.plans.catalog import query
from riskframe.plans.sizing import broadcast_if_small
from riskframe.sources import dims
from riskframe.sources.tables import customer_dim, read_table, session_memo, txn, with_txn

AS_OF = "2025-01-01"
U = seeded.sql_uniform
H = seeded.sql_h


# ------------------------------------------------------------------ weighted (inverse CDF)

def _category_cdf(spark, sf_dir):
    weights = read_table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("w"))
    return assign.cdf_dim(weights, "p_type", "w")


def _events_with_category(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id")
    return assign.range_lookup(ev.withColumn("u", seeded.uniform("cat", "event_id")), "u", _category_cdf(spark, sf_dir))


CDF_SQL = """cat_w AS (SELECT p_type, COUNT(*) AS w FROM part GROUP BY p_type),
cat_c AS (SELECT p_type, w,
                 CASE WHEN ROW_NUMBER() OVER (ORDER BY p_type DESC) = 1 THEN 1.0
                      ELSE CAST(SUM(w) OVER (ORDER BY p_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
                           / CAST(SUM(w) OVER () AS DOUBLE) END AS hi
          FROM cat_w),
cat_cdf AS (SELECT p_type, w, COALESCE(LAG(hi) OVER (ORDER BY p_type), 0.0) AS lo, hi FROM cat_c),
ev_cat AS (SELECT e.event_id, c.p_type AS category
           FROM (SELECT event_id, """ + U("cat", "event_id") + """ AS u FROM events) e
           LEFT JOIN cat_cdf c ON c.lo < e.u AND e.u <= c.hi)"""


@query("weighted_assign", "WITH " + CDF_SQL + "\nSELECT event_id, category FROM ev_cat")
def weighted_assign(spark, sf_dir):
    """Each event draws a merchant category from the category shares of ``part`` (inverse CDF)."""
    return _events_with_category(spark, sf_dir).select("event_id", F.col("p_type").alias("category"))


@query("cdf_dim", "WITH " + CDF_SQL + "\nSELECT p_type, w, lo, hi FROM cat_cdf")
def cdf_dim_query(spark, sf_dir):
    """The cumulative-share dimension itself (running sum / total, last upper bound 1)."""
    return _category_cdf(spark, sf_dir)


# ------------------------------------------------------------------ nearest key (C4)

NEAREST_SQL = """
WITH nw AS (SELECT n.n_nationkey, n.n_name, COUNT(*) AS w
            FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_nationkey, n.n_name),
nk AS (SELECT n_nationkey, n_name,
              CASE WHEN ROW_NUMBER() OVER (ORDER BY n_nationkey DESC) = 1 THEN 1.0
                   ELSE CAST(SUM(w) OVER (ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
                        / CAST(SUM(w) OVER () AS DOUBLE) END AS cdf_key
       FROM nw),
e AS (SELECT event_id, """ + U("loc", "event_id") + """ AS u FROM events),
ranked AS (SELECT e.event_id, nk.n_name, nk.cdf_key,
                  ROW_NUMBER() OVER (PARTITION BY e.event_id ORDER BY abs(nk.cdf_key - e.u), nk.cdf_key) AS rn
           FROM e CROSS JOIN nk)
SELECT event_id, n_name AS city, cdf_key FROM ranked WHERE rn = 1"""


@query("nearest_assign", NEAREST_SQL)
def nearest_assign(spark, sf_dir):
    """Each event takes the location whose CDF key is nearest to its draw (ties to the lower key)."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    w = cust.join(broadcast_if_small(nation, 10_000), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey", "n_name").agg(
        F.count(F.lit(1)).alias("w")
    )
    keys = assign.cdf_dim(w, "n_nationkey", "w").select("n_nationkey", "n_name", F.col("hi").alias("cdf_key"))
    dim = assign.nearest_dim(keys, "cdf_key")
    ev = read_table(spark, sf_dir, "events").select("event_id").withColumn("u", seeded.uniform("loc", "event_id"))
    return assign.range_lookup(ev, "u", dim).select("event_id", F.col("n_name").alias("city"), "cdf_key")


# ------------------------------------------------------------------ segment rules

def _age_years_int(dob_col, as_of=AS_OF):
    dob = F.to_date(F.col(dob_col))
    asof = F.lit(as_of).cast("date")
    before = (F.month(asof) * 100 + F.dayofmonth(asof)) < (F.month(dob) * 100 + F.dayofmonth(dob))
    return (F.year(asof) - F.year(dob) - F.when(before, 1).otherwise(0)).cast("bigint")


def _sql_age(dob="dob", as_of=AS_OF):
    d = f"CAST({dob} AS DATE)"
    a = f"DATE '{as_of}'"
    return (f"CAST(year({a}) - year({d}) - CASE WHEN month({a}) * 100 + day({a}) < month({d}) * 100 + day({d}) "
            f"THEN 1 ELSE 0 END AS BIGINT)")


def customer_segments(spark, sf_dir, rules=None):
    """Customers with integer age, first matching profile and match count."""
    if rules is None:
        return session_memo(spark, ("segments", sf_dir), lambda: _customer_segments(spark, sf_dir, None))
    return _customer_segments(spark, sf_dir, rules)


def _customer_segments(spark, sf_dir, rules):
    cust = customer_dim(spark, sf_dir).select("customer_id", "gender", "city_pop", "dob", _age_years_int("dob").alias("age"))
    return assign.first_matching_rule(cust, dims.segment_rules(spark, rules))


def _rules_sql(rules=None):
    rules = dims.DEFAULT_SEGMENT_RULES if rules is None else rules
    rows = []
    for i, (name, r) in enumerate(rules.items(), start=1):
        genders = "[" + ", ".join(f"'{g}'" for g in r["gender"]) + "]"
        amax = "NULL" if r["age"]["max"] < 0 else f"{float(r['age']['max'])}"
        pmax = "NULL" if r["city_pop"]["max"] < 0 else f"{float(r['city_pop']['max'])}"
        rows.append(f"({i}, '{name}', {genders}, {float(r['age']['min'])}, {amax}, {float(r['city_pop']['min'])}, {pmax})")
    return ("rules(prio, profile, genders, age_min, age_max, pop_min, pop_max) AS (VALUES " + ", ".join(rows) + ")")


SEG_CTES = (
    "cust_age AS (SELECT customer_id, gender, city_pop, dob, " + _sql_age() + " AS age FROM cust_dim),\n"
    + _rules_sql() + """,
seg_m AS (SELECT c.customer_id, r.prio, r.profile FROM cust_age c JOIN rules r
          ON list_contains(r.genders, c.gender) AND c.age >= r.age_min AND (r.age_max IS NULL OR c.age < r.age_max)
             AND c.city_pop >= r.pop_min AND (r.pop_max IS NULL OR c.city_pop < r.pop_max)),
seg_f AS (SELECT customer_id, arg_min(profile, prio) AS profile, COUNT(*) AS n FROM seg_m GROUP BY customer_id),
seg AS (SELECT c.customer_id, c.age, COALESCE(f.profile, '""" + dims.LEFTOVER_PROFILE + """') AS profile,
               CAST(COALESCE(f.n, 0) AS BIGINT) AS n_matches
        FROM cust_age c LEFT JOIN seg_f f ON c.customer_id = f.customer_id)"""
)


@query("segment_assign", with_txn("SELECT customer_id, age, profile, n_matches FROM seg", SEG_CTES))
def segment_assign(spark, sf_dir):
    return customer_segments(spark, sf_dir).select("customer_id", "age", "profile", "n_matches")


@query("segment_overlaps", with_txn("SELECT customer_id, age, profile, n_matches FROM seg WHERE n_matches > 1", SEG_CTES))
def segment_overlaps(spark, sf_dir):
    """Customers matching more than one rule (the reference appended these to a local log file)."""
    seg = customer_segments(spark, sf_dir)
    return seg.where(F.col("n_matches") > 1).select("customer_id", "age", "profile", "n_matches")


@query("top_segments", with_txn(
    "SELECT profile, COUNT(*) AS n FROM seg GROUP BY profile ORDER BY n DESC, profile LIMIT 10", SEG_CTES))
def top_segments(spark, sf_dir):
    from riskframe.operators.stats import top_k_counts

    return top_k_counts(customer_segments(spark, sf_dir), "profile", 10)


FILTER_PROFILE = "young_female.json"


@query("filter_profile", with_txn(
    f"SELECT t.event_id, t.customer_id, t.category, t.amt, s.profile FROM txn t JOIN seg s "
    f"ON t.customer_id = s.customer_id WHERE s.profile = '{FILTER_PROFILE}'", SEG_CTES))
def filter_profile(spark, sf_dir):
    """Transactions of one segment; the filter is applied to customers before the join."""
    seg = customer_segments(spark, sf_dir).where(F.col("profile") == FILTER_PROFILE).select("customer_id", "profile")
    t = txn(spark, sf_dir).select("event_id", "customer_id", "category", "amt")
    return t.join(seg, "customer_id").select("event_id", "customer_id", "category", "amt", "profile")


def _profile_settings_sql():
    rows = [f"('{p}', {s['avg_transactions_per_day']['min']}, {s['avg_transactions_per_day']['max']})"
            for p, s in dims.DEFAULT_PROFILE_SETTINGS.items()]
    return "ps(profile, tx_min, tx_max) AS (VALUES " + ", ".join(rows) + ")"


@query("join_profile_config", with_txn(
    """SELECT s.customer_id, s.profile, CAST(p.tx_min AS BIGINT) AS tx_min, CAST(p.tx_max AS BIGINT) AS tx_max,
              CAST(f.tx_min AS BIGINT) AS fraud_tx_min, CAST(f.tx_max AS BIGINT) AS fraud_tx_max
       FROM seg s LEFT JOIN ps p ON p.profile = s.profile LEFT JOIN ps f ON f.profile = 'fraud_' || s.profile""",
    SEG_CTES + ",\n" + _profile_settings_sql()))
def join_profile_config(spark, sf_dir):
    """Customer -> profile settings and the ``fraud_`` twin settings (two broadcast equi-joins)."""
    seg = customer_segments(spark, sf_dir).select("customer_id", "profile")
    ps = dims.profile_settings(spark)
    p = ps.select("profile", F.col("tx_min").cast("bigint").alias("tx_min"), F.col("tx_max").cast("bigint").alias("tx_max"))
    f = ps.select(F.col("profile").alias("fprofile"), F.col("tx_min").cast("bigint").alias("fraud_tx_min"),
                  F.col("tx_max").cast("bigint").alias("fraud_tx_max"))
    out = seg.join(F.broadcast(p), "profile", "left")
    out = out.join(F.broadcast(f), F.concat(F.lit("fraud_"), out["profile"]) == f["fprofile"], "left")
    return out.select("customer_id", "profile", "tx_min", "tx_max", "fraud_tx_min", "fraud_tx_max")


# ------------------------------------------------------------------ uniform pick within category

PICK_SQL = "WITH " + CDF_SQL + """,
pool AS (SELECT DISTINCT p_type, p_name, """ + H("bucket", "p_name") + """ % 256 AS bk FROM part),
bc AS (SELECT p_type, bk, COUNT(*) AS c FROM pool GROUP BY p_type, bk),
bo AS (SELECT p_type, bk, SUM(c) OVER (PARTITION BY p_type ORDER BY bk) - c AS off,
              SUM(c) OVER (PARTITION BY p_type) AS gsize FROM bc),
idx AS (SELECT p.p_type, p.p_name, bo.off + ROW_NUMBER() OVER (PARTITION BY p.p_type, p.bk ORDER BY p.p_name) AS i,
               bo.gsize FROM pool p JOIN bo ON p.p_type = bo.p_type AND p.bk = bo.bk),
sizes AS (SELECT DISTINCT p_type, gsize FROM idx),
pick AS (SELECT e.event_id, e.category,
                LEAST(1 + CAST(floor(""" + U("merch", "e.event_id") + """ * s.gsize) AS BIGINT), s.gsize) AS i
         FROM ev_cat e LEFT JOIN sizes s ON s.p_type = e.category)
SELECT pick.event_id, pick.category, idx.p_name AS merchant
FROM pick LEFT JOIN idx ON idx.p_type = pick.category AND idx.i = pick.i"""


@query("pick_merchant", PICK_SQL)
def pick_merchant(spark, sf_dir):
    """Category drawn by CDF, then a merchant (``part.p_name``) picked uniformly within it."""
    ev = _events_with_category(spark, sf_dir).select("event_id", F.col("p_type").alias("category"))
    parts = read_table(spark, sf_dir, "part").select("p_type", "p_name")
    return assign.pick_uniform(ev, "category", seeded.uniform("merch", "event_id"), parts, "p_type", "p_name",
                               out="merchant").select("event_id", "category", "merchant")


# ------------------------------------------------------------------ enrichment and anti join

@query("txn_enriched", with_txn("SELECT * FROM txn"))
def txn_enriched(spark, sf_dir):
    """Customer columns denormalised onto every transaction (the ``txn`` view)."""
    return txn(spark, sf_dir)


@query("anti_fraud_dates", with_txn("""
SELECT t.event_id, t.customer_id, t.trans_date FROM txn t
WHERE t.is_fraud = 0 AND NOT EXISTS (
  SELECT 1 FROM txn f WHERE f.is_fraud = 1 AND f.customer_id = t.customer_id AND f.trans_date = t.trans_date)"""))
def anti_fraud_dates(spark, sf_dir):
    """Clean transactions minus those on a date where the same customer has a fraud one."""
    t = txn(spark, sf_dir).select("event_id", "customer_id", "trans_date", "is_fraud")
    fraud_days = t.where(F.col("is_fraud") == 1).select("customer_id", "trans_date").dropDuplicates()
    clean = t.where(F.col("is_fraud") == 0)
    return clean.join(fraud_days, ["customer_id", "trans_date"], "left_anti").select("event_id", "customer_id", "trans_date")


# ------------------------------------------------------------------ calendar

def _sql_calendar_ctes():
    dow = dims.DEFAULT_DAY_OF_WEEK
    wd_rows = ", ".join(f"({n}, CAST({float(dow.get(name, 100))} AS DOUBLE))" for name, n in dims.WEEKDAY_NUMBER.items())
    hol_rows = ", ".join(f"({i}, '{h['start']}', '{h['end']}', CAST({float(h['weight'])} AS DOUBLE))"
                         for i, h in enumerate(dims.DEFAULT_HOLIDAYS, start=1))
    yr_rows = ", ".join(f"({y}, CAST({float(w)} AS DOUBLE))" for y, w in dims.DEFAULT_YEAR_WEIGHTS.items())
    return f"""span AS (SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
             (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders), (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders),
             INTERVAL 1 DAY)) AS d)),
wd(weekday, weight) AS (VALUES {wd_rows}),
wds AS (SELECT weekday, weight / SUM(weight) OVER () AS wd_share FROM wd),
hol(rule_no, start_md, end_md, weight) AS (VALUES {hol_rows}),
hol_days AS (SELECT rule_no, weight, CAST(unnest(generate_series(
               make_date(2000, CAST(split_part(start_md, '-', 1) AS INTEGER), CAST(split_part(start_md, '-', 2) AS INTEGER)),
               make_date(2000, CAST(split_part(end_md, '-', 1) AS INTEGER), CAST(split_part(end_md, '-', 2) AS INTEGER)),
               INTERVAL 1 DAY)) AS DATE) AS d FROM hol),
hol_md AS (SELECT month(d) AS month, day(d) AS day, arg_max(weight, rule_no) AS hweight FROM hol_days GROUP BY 1, 2),
grid AS (SELECT month(d) AS month, day(d) AS day FROM (SELECT unnest(generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS d)),
md AS (SELECT g.month, g.day, COALESCE(h.hweight, CAST(100.0 AS DOUBLE)) AS weight FROM grid g LEFT JOIN hol_md h ON g.month = h.month AND g.day = h.day),
mds AS (SELECT month, day, weight / SUM(weight) OVER () AS leap_share,
               CASE WHEN month = 2 AND day = 29 THEN NULL
                    ELSE weight / SUM(CASE WHEN month = 2 AND day = 29 THEN 0.0 ELSE weight END) OVER () END AS common_share
        FROM md),
req AS (SELECT year, ROW_NUMBER() OVER (ORDER BY year) AS i FROM (SELECT DISTINCT year(date) AS year FROM span)),
cfg(cfg_year, weight) AS (VALUES {yr_rows}),
cfgi AS (SELECT cfg_year, weight, ROW_NUMBER() OVER (ORDER BY cfg_year) AS i FROM cfg),
yw AS (SELECT r.year, COALESCE(c.weight, CAST(100.0 AS DOUBLE)) AS weight FROM req r LEFT JOIN cfgi c ON r.i = c.i),
yws AS (SELECT year, weight, weight / SUM(weight) OVER () AS share FROM yw)"""


CAL_SQL = "WITH " + _sql_calendar_ctes() + f""",
cal AS (SELECT s.date, CAST(isodow(s.date) - 1 AS BIGINT) AS weekday,
               y.share * CASE WHEN year(s.date) % 4 = 0 THEN m.leap_share ELSE m.common_share END * w.wd_share AS w
        FROM span s JOIN yws y ON y.year = year(s.date)
                    JOIN mds m ON m.month = month(s.date) AND m.day = day(s.date)
                    JOIN wds w ON w.weekday = isodow(s.date) - 1)
SELECT date, weekday, {R('w / SUM(w) OVER ()', 10)} AS weight FROM cal"""


def _order_days(spark, sf_dir):
    return calendar.date_span(read_table(spark, sf_dir, "orders"), "o_orderdate")


@query("calendar_weights", CAL_SQL)
def calendar_weights(spark, sf_dir):
    cal = calendar.calendar_weights(spark, _order_days(spark, sf_dir))
    return cal.select("date", "weekday", rh(F.col("weight"), 10).alias("weight"))


@query("holiday_weights", "WITH " + _sql_calendar_ctes() + """
SELECT s.date, m.weight FROM span s JOIN md m ON m.month = month(s.date) AND m.day = day(s.date)""")
def holiday_weights(spark, sf_dir):
    """Holiday weight of every day in the orders date span (last matching rule wins, else 100)."""
    md = calendar.holiday_month_days(spark)
    days = _order_days(spark, sf_dir)
    d = days.select("date", F.month("date").alias("month"), F.dayofmonth("date").alias("day"))
    return d.join(F.broadcast(md), ["month", "day"]).select("date", "weight")


@query("year_weights", "WITH " + _sql_calendar_ctes() + f"""
SELECT CAST(year AS BIGINT) AS year, weight, {R('share', 10)} AS share FROM yws""")
def year_weights_query(spark, sf_dir):
    days = _order_days(spark, sf_dir).select(F.year("date").alias("year"))
    yw = calendar.year_weights(spark, days, "year")
    return yw.select(F.col("year").cast("bigint").alias("year"), "weight", rh(F.col("share"), 10).alias("share"))
