"""Date helpers: multi-format parsing and birth dates from ages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions import seeded

# Accepted input formats, tried in this order (month-day-year, ISO, day/month/year).
DATE_FORMATS = ["M-d-yyyy", "yyyy-M-d", "d/M/yyyy"]


def parse_date_multi(col: Column | str, formats: list[str] | None = None) -> Column:
    """First format that parses wins; text matching none gives NULL (no ANSI error)."""
    c = F.col(col) if isinstance(col, str) else col
    fmts = DATE_FORMATS if formats is None else formats
    return F.coalesce(*[F.try_to_date(c, f) for f in fmts])


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def with_dob_from_age(df: DataFrame, age: str, key: str, as_of: str, out: str = "dob", salt: str = "dob") -> DataFrame:
    """Adds a birth date for someone ``age`` years old on ``as_of``.

    A seeded month-day is drawn from a leap-year calendar; the birth year is
    ``year(as_of) - age``, one less when that month-day is still ahead of ``as_of``'s.
    29 Feb in a common birth year is replaced by a second draw from a 365-day calendar.
    """
    asof = F.lit(as_of).cast("date")
    d = df.withColumns({
        "_md1": F.date_add(F.lit("2000-01-01").cast("date"), (seeded.h(salt, key) % 366).cast("int")),
        "_md2": F.date_add(F.lit("2001-01-01").cast("date"), (seeded.h(salt + "2", key) % 365).cast("int")),
    })

    def birth_year(md):
        ahead = (F.month(asof) * 100 + F.dayofmonth(asof)) < (F.month(md) * 100 + F.dayofmonth(md))
        return F.year(asof) - F.col(age) - F.when(ahead, 1).otherwise(0)

    md1 = F.col("_md1")
    feb29_invalid = (F.month(md1) == 2) & (F.dayofmonth(md1) == 29) & ~is_leap(birth_year(md1))
    d = d.withColumn("_md", F.when(feb29_invalid, F.col("_md2")).otherwise(md1))
    md = F.col("_md")
    return d.withColumn(out, F.make_date(birth_year(md), F.month(md), F.dayofmonth(md))).drop("_md1", "_md2", "_md")
