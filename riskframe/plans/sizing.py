"""Size-checked broadcast.

A side is broadcast only when a bounded count proves it holds at most ``max_rows`` rows;
otherwise the frame is returned unchanged and Catalyst plans a shuffle join (sort-merge or
shuffled hash, with AQE skew splitting). The count reads at most ``max_rows + 1`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when it holds at most ``max_rows`` rows, else ``df`` unchanged.

    Counted on every call, since tables may have grown since the last one."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
