"""Every query with a SQL oracle gives the same rows as DuckDB on the same tables (sf0.001)."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _oracles():
    from __spark_entry__ import oracle_sql

    return oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime
    import decimal

    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("key", sorted(_oracles()))
def test_matches_duckdb(spark, duck, key):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[key](spark, SF_SMALL)
    rows = df.collect()
    rel = duck.execute(oracle_sql()[key])
    drows = rel.fetchall()
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    si = [df.columns.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
    assert len(a) == len(b)
    assert a == b


def test_every_query_has_a_callable(spark):
    from __spark_entry__ import oracle_sql, queries

    qs = queries()
    assert set(oracle_sql()) <= set(qs)
    assert len(qs) >= 60


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["bin_id", "range_start", "range_end", "frequency", "percentage"]
