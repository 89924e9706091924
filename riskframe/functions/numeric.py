"""Numeric helpers that behave the same in Spark and in the DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(col: Column | str, digits: int) -> Column:
    """Round through DECIMAL(38,10) then back to double.

    Rounding a double directly differs between engines on ties (Spark rounds the shortest
    decimal text half-up, DuckDB rounds the binary value). Going through a 10-digit decimal
    first gives the same answer in both.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


def sql_round_half_up(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def round_sig(col: Column | str, digits: int) -> Column:
    """Round to ``digits`` significant digits (same result in DuckDB via :func:`sql_round_sig`)."""
    c = F.col(col) if isinstance(col, str) else col
    e = F.floor(F.log10(F.abs(c)))
    scale = F.pow(F.lit(10.0), e.cast("double"))
    return F.when(c == 0, F.lit(0.0)).otherwise(round_half_up(c / scale, digits - 1) * scale)


def sql_round_sig(expr: str, digits: int) -> str:
    scale = f"pow(10.0, CAST(floor(log10(abs({expr}))) AS DOUBLE))"
    return f"(CASE WHEN ({expr}) = 0 THEN 0.0 ELSE {sql_round_half_up(f'({expr}) / {scale}', digits - 1)} * {scale} END)"
