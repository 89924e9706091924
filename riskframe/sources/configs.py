"""Readers of configuration and lookup files: JSON documents over several lines, demographics, merchants.

Files of this kind are small and few; each is read whole, so that line order and documents survive, and a document that does
not parse is returned with its text instead of failing the job or vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import assign
from riskframe.sources import files
from riskframe.sources.dims import LEFTOVER_PROFILE

RANGE = "struct<min: double, max: double>"
RULES = f"map<string, struct<gender: array<string>, age: {RANGE}, city_pop: {RANGE}>>"
SETTINGS = ("map<string, struct<avg_transactions_per_day: struct<min: int, max: int>, shopping_time: struct<AM: int, PM: int>>>")


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, doc, _corrupt_record) per file below ``path``: the parsed document, or its text if it is not one."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    doc = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    return raw.select("file", doc.alias("doc"), "value").select(
        "file", "doc", F.when(F.col("doc").isNull(), F.col("value")).alias("_corrupt_record"))


def read_profile_settings(spark: SparkSession, path: str) -> DataFrame:
    """(profile, tx_min, tx_max, am_weight, pm_weight) of every profile in the settings documents below ``path``."""
    docs = json_documents(spark, path, SETTINGS)
    return docs.select(F.explode("doc").alias("profile", "s")).select(
        "profile", F.col("s.avg_transactions_per_day.min").alias("tx_min"), F.col("s.avg_transactions_per_day.max").alias("tx_max"),
        F.col("s.shopping_time.AM").alias("am_weight"), F.col("s.shopping_time.PM").alias("pm_weight"))


def read_segment_rules(spark: SparkSession, path: str) -> DataFrame:
    """(prio, profile, genders, age_min, age_max, pop_min, pop_max) in document order, as :func:`dims.segment_rules` gives them;
    a negative maximum is open (null), the leftover profile has no rule."""
    docs = json_documents(spark, path, RULES)
    rows = docs.select(F.posexplode("doc").alias("pos", "profile", "r")).where(F.col("profile") != LEFTOVER_PROFILE)
    top = lambda c: F.when(c >= 0, c)
    return rows.select(
        (F.col("pos") + 1).alias("prio"), "profile", F.col("r.gender").alias("genders"), F.col("r.age.min").alias("age_min"),
        top(F.col("r.age.max")).alias("age_max"), F.col("r.city_pop.min").alias("pop_min"), top(F.col("r.city_pop.max")).alias("pop_max"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of one small file, without its header and empty lines."""
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return lines.where((F.col("line_no") > 0) & (F.trim("line") != ""))


def read_age_gender(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, age, gender, share, lo, hi) of a file ``group,age,gender,share``: shares cumulated in line order."""
    part: list[Column] = [F.trim(F.get(F.split("line", ","), F.lit(i))) for i in range(4)]
    rows = _lines(spark, path).select("line_no", part[1].try_cast("double").alias("age"), part[2].alias("gender"),
                                      part[3].try_cast("double").alias("share"))
    return assign.cdf_dim(rows, "line_no", "share")


def read_merchants(spark: SparkSession, path: str) -> DataFrame:
    """(category, merchant) of a file ``category|merchant``."""
    return files.read_delimited(spark, path, "category STRING, merchant STRING", sep="|")
