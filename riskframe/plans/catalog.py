"""Query catalogue: every operator as a callable ``(spark, sf_dir) -> DataFrame``.

Each entry reads the driver tables (or the ``txn`` view derived from them) in full.
The matching DuckDB text (the oracle) is registered next to each query; keys whose result
is not expressible in SQL (model fits, random draws from MLlib) register none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def all_queries() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from riskframe.plans import (  # noqa: F401
        q_assign,
        q_encode,
        q_files,
        q_metrics,
        q_model,
        q_sampling,
        q_sources,
        q_stats,
    )

    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    all_queries()
    return dict(ORACLE)
