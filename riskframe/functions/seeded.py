"""Seeded randomness as pure column expressions.

Every draw is a function of (salt, key) only, never of partition, task or attempt, so a
re-executed task (lost executor, speculative copy) and a different partitioning produce the
same rows. ``H(salt, key)`` is the first 32 bits of ``md5(salt || '|' || key)`` as a bigint;
the DuckDB twin in :func:`sql_h` gives the same integers, which is what lets seeded operators
carry an exact SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(key) -> Column:
    if isinstance(key, str):
        key = F.col(key)
    return key.cast("string")


def h(salt: str, key) -> Column:
    """Integer in [0, 2^32) from md5(salt|key)."""
    digest = F.md5(F.concat(F.lit(salt), F.lit("|"), _key(key)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def uniform(salt: str, key) -> Column:
    """Double in (0, 1]: (H + 1) / 2^32, so ``lo < u <= hi`` buckets cover every row once."""
    return (h(salt, key) + F.lit(1)).cast("double") / F.lit(TWO_32)


def randint(salt: str, key, lo, hi) -> Column:
    """Integer in [lo, hi] (both may be columns)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return lo_c + F.pmod(h(salt, key), hi_c - lo_c + F.lit(1))


def compound_key(*parts) -> Column:
    """A string key from several columns, '-' separated (same text in DuckDB)."""
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    out = cols[0].cast("string")
    for c in cols[1:]:
        out = F.concat(out, F.lit("-"), c.cast("string"))
    return out


# ---- DuckDB twins (used only by the oracle SQL text) ----

def sql_h(salt: str, key_sql: str) -> str:
    return f"CAST(('0x' || substr(md5('{salt}' || '|' || CAST({key_sql} AS VARCHAR)), 1, 8)) AS BIGINT)"


def sql_uniform(salt: str, key_sql: str) -> str:
    return f"(CAST({sql_h(salt, key_sql)} + 1 AS DOUBLE) / 4294967296.0)"


def sql_compound_key(*parts: str) -> str:
    return " || '-' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)


def with_uniforms(df, salt: str, key, names: list[str]):
    """Adds one (0, 1] draw per name. Four draws share one md5 digest of (salt#j, key), one per
    32-bit quarter, so n draws cost ceil(n / 4) digests instead of n."""
    k = _key(key)
    digests = {}
    for j in range((len(names) + 3) // 4):
        digests[f"_dg{j}"] = F.md5(F.concat(F.lit(f"{salt}#{j}"), F.lit("|"), k))
    out = df.withColumns(digests)
    cols = {}
    for i, name in enumerate(names):
        quarter = F.substring(F.col(f"_dg{i // 4}"), 1 + 8 * (i % 4), 8)
        cols[name] = (F.conv(quarter, 16, 10).cast("bigint") + F.lit(1)).cast("double") / F.lit(TWO_32)
    return out.withColumns(cols).drop(*digests)


def int_from_uniform(u: Column, lo, hi) -> Column:
    """The integer in [lo, hi] that :func:`randint` gives for the hash behind draw ``u``."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    raw = (u * F.lit(TWO_32) - F.lit(1.0)).cast("bigint")
    return lo_c + F.pmod(raw, hi_c - lo_c + F.lit(1))


def digest(salt: str, key) -> Column:
    """md5 text of (salt, key); :func:`quarter` cuts it into four independent 32-bit hashes.
    Materialise it as a column once and read several quarters from it."""
    return F.md5(F.concat(F.lit(f"{salt}#0"), F.lit("|"), _key(key)))


def quarter(digest_col, i: int) -> Column:
    """Hash number ``i`` (0..3) in [0, 2^32) from a :func:`digest` column."""
    c = F.col(digest_col) if isinstance(digest_col, str) else digest_col
    return F.conv(F.substring(c, 1 + 8 * i, 8), 16, 10).cast("bigint")


def sql_quarter(salt: str, key_sql: str, i: int) -> str:
    return (f"CAST(('0x' || substr(md5('{salt}#0' || '|' || CAST({key_sql} AS VARCHAR)), {1 + 8 * i}, 8)) "
            f"AS BIGINT)")


def sql_draw(salt: str, key_sql: str, i: int) -> str:
    """DuckDB twin of the hash behind draw ``i`` of :func:`with_uniforms`."""
    return (f"CAST(('0x' || substr(md5('{salt}#{i // 4}' || '|' || CAST({key_sql} AS VARCHAR)), {1 + 8 * (i % 4)}, 8)) "
            f"AS BIGINT)")
