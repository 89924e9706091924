"""Seeded, partition-independent sampling: split, folds, oversampling, class weights,
row expansion and the generator's per-row draws (fraud window, time of day, location jitter,
gamma amounts)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions import seeded
from riskframe.plans.sizing import broadcast_if_small


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 42, col: str = "split") -> DataFrame:
    """'train' when the seeded draw of ``key`` is <= ``train_fraction``, else 'test'.

    Unlike ``randomSplit`` the result does not depend on partitioning or row order.
    """
    u = seeded.uniform(f"split{seed}", key)
    return df.withColumn(col, F.when(u <= F.lit(train_fraction), F.lit("train")).otherwise(F.lit("test")))


def assign_folds(df: DataFrame, key: str, k: int = 3, seed: int = 42, col: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from the key hash (use as ``foldCol`` of CrossValidator)."""
    return df.withColumn(col, F.pmod(seeded.h(f"fold{seed}", key), F.lit(k)).cast("int"))


def class_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row (n1, n0): minority (label 1) and majority counts in one pass."""
    y = F.col(label)
    return df.agg(
        F.coalesce(F.sum(F.when(y == 1, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("n1"),
        F.coalesce(F.sum(F.when(y == 0, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("n0"),
    )


#: Copies of one row that are made from one array.
COPIES_AT_ONCE = 4_096


def oversample_ratio(n1: Column, n0: Column, target: float, trigger: float) -> Column:
    """r = target * n0 / (n1 * (1 - target)) when 0 < n1/(n1+n0) < trigger, else NULL (unchanged)."""
    share = n1.cast("double") / (n1 + n0).cast("double")
    ratio = (F.lit(target) * n0.cast("double")) / (n1.cast("double") * (F.lit(1.0) - F.lit(target)))
    return F.when((n1 > 0) & (share < F.lit(trigger)), ratio)


def poisson_count(rate: Column, u: Column) -> Column:
    """Inverse-CDF Poisson draw: the smallest k with P(X <= k) >= u, as one JVM-side fold.

    The fold runs over ``rate`` +- (40 sqrt(rate) + 40), outside of which the probabilities are too
    small to count in double precision. They are kept as logarithms, since exp(-rate) is zero for rates
    above 745; a fold that does not start at zero takes its first one from Stirling's series."""
    reach = F.lit(40.0) * F.sqrt(rate) + F.lit(40.0)
    low = F.floor(rate - reach)
    first = F.when(low >= 100, low).otherwise(F.lit(0)).cast("bigint")
    n = F.greatest(low.cast("double"), F.lit(1.0))
    log_factorial = (n * F.ln(n) - n + F.lit(0.5) * F.ln(F.lit(2 * math.pi) * n) + F.lit(1.0) / (F.lit(12.0) * n)
                     - F.lit(1.0) / (F.lit(360.0) * n * n * n))
    start = F.when(first == 0, -rate).otherwise(n * F.ln(rate) - rate - log_factorial)
    init = F.struct(start.alias("logp"), F.exp(start).alias("cdf"), first.alias("k"))

    def step(acc, i):
        nxt = acc["logp"] + F.ln(rate) - F.ln((i + F.lit(1)).cast("double"))
        return F.when(acc["cdf"] >= u, acc).otherwise(
            F.struct(nxt.alias("logp"), (acc["cdf"] + F.exp(nxt)).alias("cdf"), (i + F.lit(1)).cast("bigint").alias("k")))

    return F.aggregate(F.sequence(first, F.ceil(rate + reach).cast("bigint")), init, step)["k"]


def balance_oversample(df: DataFrame, key: str, label: str = "is_fraud", target: float = 0.3, trigger: float = 0.1,
                       seed: int = 42, method: str = "expected") -> DataFrame:
    """Oversample label 1 to about ``target`` share when its share is below ``trigger``.

    ``method="expected"``: each minority row is repeated ``floor(r) + [u < frac(r)]`` times
    (expected count r per row, lowest variance). ``method="poisson"``: Poisson(r) copies, the
    bootstrap that ``sample(withReplacement=True)`` performs, but seeded by the key so it does
    not depend on partitioning. Majority rows are kept once; adds ``copy`` (1..). The class
    counts are one aggregate row joined by broadcast, so no data reaches the driver. With no
    minority rows or a share at or above ``trigger`` every row is kept once.
    """
    stats = class_counts(df, label).select(oversample_ratio(F.col("n1"), F.col("n0"), target, trigger).alias("_r"))
    df = df.withColumn("_u", seeded.uniform(f"over{seed}", key))
    u = F.col("_u")
    r = F.col("_r")
    if method == "poisson":
        draw = poisson_count(r, u)
    elif method == "expected":
        draw = F.floor(r) + F.when(u < r - F.floor(r), 1).otherwise(0)
    else:
        raise ValueError(f"unknown method {method}")
    copies = F.when(r.isNull() | (F.col(label) != 1), F.lit(1)).otherwise(draw).cast("bigint")
    with_n = df.crossJoin(F.broadcast(stats)).withColumn("_n", copies)
    # in two steps, so no row holds an array of all its copies
    step = F.lit(COPIES_AT_ONCE).cast("bigint")
    runs = with_n.where(F.col("_n") > 0).withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), step)))
    until = F.least(F.col("_from") + step - F.lit(1), F.col("_n"))
    rows = runs.withColumn("copy", F.explode(F.sequence(F.col("_from"), until)))
    return rows.withColumn("copy", F.col("copy").cast("int")).drop("_r", "_n", "_u", "_from")


def spark_sample_oversample(df: DataFrame, label: str = "is_fraud", target: float = 0.3, trigger: float = 0.1,
                            seed: int = 42) -> DataFrame:
    """The reference's form: Poisson bootstrap ``sample(True, r, seed)`` of the minority.

    Depends on partitioning (kept for parity; prefer :func:`balance_oversample`)."""
    row = class_counts(df, label).first()
    n1, n0 = row["n1"], row["n0"]
    if n1 == 0 or n1 / (n1 + n0) >= trigger:
        return df
    r = (target * n0) / (n1 * (1 - target))
    return df.where(F.col(label) == 0).unionByName(df.where(F.col(label) == 1).sample(True, r, seed))


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """(label, n, weight) with weight = N / (k * n_c) ('balanced')."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    w = Window.partitionBy()
    return per.select(
        label, "n",
        (F.sum("n").over(w).cast("double") / (F.count(F.lit(1)).over(w).cast("double") * F.col("n").cast("double"))).alias("weight"),
    )


def with_class_weight(df: DataFrame, label: str = "is_fraud", col: str = "weight") -> DataFrame:
    """Attach the balanced class weight to each row (broadcast of a k-row table)."""
    cw = class_weights(df, label).select(label, F.col("weight").alias(col))
    return df.join(broadcast_if_small(cw, 100_000), label, "left")


def expand_rows(df: DataFrame, key: str, days: Column, lo: Column, hi: Column, salt: str = "ntx") -> DataFrame:
    """One row per generated transaction: ``days * U{lo..hi}`` rows for each input row,
    numbered by ``txn_no`` (narrow explode, no shuffle)."""
    n = (days * seeded.randint(salt, key, lo, hi)).cast("int")
    return df.withColumn("n_txn", n).where(F.col("n_txn") > 0).withColumn(
        "txn_no", F.explode(F.sequence(F.lit(1), F.col("n_txn")))
    )


def fraud_window(df: DataFrame, key: str, span_start: Column, span_days: Column, p_fraud: float = 99 / 101,
                 seed: int = 42) -> DataFrame:
    """Per customer: fraud flag (seeded ``u < p_fraud``) and a one-day fraud window starting
    ``U{1..max(days-7, 1)}`` days after the span start. Each draw is a column computed once."""
    out = df.withColumns({
        "fraud_customer": (seeded.uniform(f"fraudgate{seed}", key) < F.lit(p_fraud)).cast("int"),
        "_fs": F.date_add(span_start, seeded.randint(f"fraudday{seed}", key, 1,
                                                     F.greatest(span_days - F.lit(7), F.lit(1))).cast("int")),
    })
    on = F.col("fraud_customer") == 1
    return out.withColumns({
        "fraud_start": F.when(on, F.col("_fs")),
        "fraud_end": F.when(on, F.date_add(F.col("_fs"), 1)),
    }).drop("_fs")


def with_daypart_time(df: DataFrame, key: str, am_weight: Column, pm_weight: Column, is_fraud: Column,
                      seed: int = 42, draws: dict[str, Column] | None = None) -> DataFrame:
    """Adds daypart, hour, minute, second and 'HH:mm:ss' trans_time.

    Day part by the AM/PM weights, then hour (AM 0-11, PM 12-23; fraud rows 80 % of the time
    AM 0-3 / PM 22-23), minute and second. Draws are added as columns step by step so every
    hash is computed once per row."""
    def u(name):
        return draws[name] if draws else seeded.uniform(f"{name}{seed}", key)

    def rint(name, lo, hi):
        return seeded.int_from_uniform(draws[name], lo, hi) if draws else seeded.randint(f"{name}{seed}", key, lo, hi)

    am_share = am_weight.cast("double") / (am_weight + pm_weight).cast("double")
    out = df.withColumns({
        "daypart": F.when(u("daypart") <= am_share, F.lit("AM")).otherwise(F.lit("PM")),
        "_night": (is_fraud == 1) & (rint("night", 1, 100) > 20),
    })
    am, night = F.col("daypart") == "AM", F.col("_night")
    out = out.withColumns({
        "_lo": F.when(am, F.lit(0)).otherwise(F.when(night, F.lit(22)).otherwise(F.lit(12))),
        "_hi": F.when(am, F.when(night, F.lit(3)).otherwise(F.lit(11))).otherwise(F.lit(23)),
    })
    out = out.withColumns({
        "hour": rint("hour", F.col("_lo"), F.col("_hi")).cast("bigint"),
        "minute": rint("minute", 0, 59).cast("bigint"),
        "second": rint("second", 0, 59).cast("bigint"),
    })
    two = [F.coalesce(F.lpad(F.col(c).cast("string"), 2, "0"), F.lit("null")) for c in ("hour", "minute", "second")]
    return out.withColumn("trans_time", F.concat_ws(":", *two)).drop("_night", "_lo", "_hi")


def geo_jitter(center: Column, key: str, salt: str, travelling: Column | bool = False, travel_max: Column | float = 0.0,
               u: Column | None = None) -> Column:
    """center + (2u - 1) * radius; radius 1 degree, or travel_max / 100 * 1.43 when travelling."""
    trav = travelling if isinstance(travelling, Column) else F.lit(bool(travelling))
    tmax = travel_max if isinstance(travel_max, Column) else F.lit(float(travel_max))
    radius = F.when(trav, tmax / F.lit(100.0) * F.lit(1.43)).otherwise(F.lit(1.0))
    u = seeded.uniform(salt, key) if u is None else u
    return center + (F.lit(2.0) * u - F.lit(1.0)) * radius


#: Attempts of a gamma draw; each is accepted with a probability above 0.95, so all fail once in 10**41 draws.
GAMMA_TRIES = 32


def _once(value: Column, fn) -> Column:
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _gamma_d(shape: Column) -> Column:
    return F.when(shape < 1, shape + F.lit(1.0)).otherwise(shape) - F.lit(1.0) / F.lit(3.0)


def _gamma_digest(salt: str, key: Column, i: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string"), F.lit("|"), i.cast("string")))


def _gamma_u(digest: Column, i: int) -> Column:
    return (seeded.quarter(digest, i) + F.lit(1)).cast("double") / F.lit(seeded.TWO_32)


def _gamma_normal(digest: Column) -> Column:
    return F.sqrt(F.lit(-2.0) * F.ln(_gamma_u(digest, 0))) * F.cos(F.lit(2.0 * math.pi) * _gamma_u(digest, 1))


def _gamma_accepted(z: Column, v: Column, u: Column, d: Column) -> Column:
    """d * v if the draw ``u`` accepts the normal ``z`` with the cube ``v``, else null."""
    limit = F.lit(0.5) * z * z + d - d * v + d * F.ln(v)
    return F.when((v > 0) & (F.ln(u) < limit), d * v)


def _gamma_fold(d: Column, key: Column, salt: str, first: int) -> Column:
    """The first accepted one of the attempts from ``first`` on."""
    def attempt(i: Column) -> Column:
        def tried(digest: Column) -> Column:
            return _once(_gamma_normal(digest), lambda z: _once(F.lit(1.0) + z / F.sqrt(F.lit(9.0) * d), lambda b: _once(
                F.struct(z.alias("z"), (b * b * b).alias("v"), _gamma_u(digest, 2).alias("u")),
                lambda t: _gamma_accepted(t["z"], t["v"], t["u"], d))))

        return _once(_gamma_digest(salt, key, i), tried)

    return F.aggregate(F.sequence(F.lit(first), F.lit(GAMMA_TRIES)), F.lit(None).cast("double"),
                       lambda acc, i: F.when(acc.isNotNull(), acc).otherwise(attempt(i)))


def _gamma_scaled(hit: Column, shape: Column, scale: Column, key: Column, salt: str) -> Column:
    boost = F.when(shape < 1, F.pow(seeded.uniform(f"{salt}_boost", key), F.lit(1.0) / shape)).otherwise(F.lit(1.0))
    return F.when(shape > 0, F.coalesce(hit, _gamma_d(shape)) * boost * scale)


def gamma_draw(shape: Column, scale: Column, key, salt: str) -> Column:
    """An exact Gamma(shape, scale) draw, a function of (salt, key): rejection from a cubed normal (Marsaglia and Tsang,
    2000) as a fold over seeded attempts, of which those after the first accepted one are not computed. Shapes below 1
    are drawn at shape + 1 and scaled by U ** (1 / shape). Null for shapes that are not positive."""
    key = F.col(key) if isinstance(key, str) else key
    return _gamma_scaled(_gamma_fold(_gamma_d(shape), key, salt, 1), shape, scale, key, salt)


def with_gamma_amount(df: DataFrame, shape: Column, scale: Column, key: str, out: str = "amount", seed: int = 42) -> DataFrame:
    """Adds a Gamma(shape, scale) draw, the one of :func:`gamma_draw`; draws below 1 are replaced by U(1, 10), as the
    reference does. The first attempt, which most rows accept, is a chain of plain columns computed once each; only rows
    that reject it run the fold, which Spark interprets."""
    salt, k = f"gamma{seed}", F.col(key)
    d = df.withColumns({"_gk": shape, "_gt": scale})
    d = d.withColumns({"_gd": F.when(F.col("_gk") > 0, _gamma_d(F.col("_gk"))), "_gm": _gamma_digest(salt, k, F.lit(1))})
    d = d.withColumns({"_gz": _gamma_normal(F.col("_gm")), "_gu": _gamma_u(F.col("_gm"), 2)})
    d = d.withColumn("_gb", F.lit(1.0) + F.col("_gz") / F.sqrt(F.lit(9.0) * F.col("_gd")))
    d = d.withColumn("_gv", F.col("_gb") * F.col("_gb") * F.col("_gb"))
    d = d.withColumn("_gh", _gamma_accepted(F.col("_gz"), F.col("_gv"), F.col("_gu"), F.col("_gd")))
    hit = F.when(F.col("_gh").isNotNull(), F.col("_gh")).otherwise(_gamma_fold(F.col("_gd"), k, salt, 2))
    d = d.withColumn("_gx", _gamma_scaled(hit, F.col("_gk"), F.col("_gt"), k, salt))
    low = F.lit(1.0) + F.lit(9.0) * seeded.uniform(f"gammalow{seed}", key)
    return d.withColumn(out, F.when(F.col("_gx") < 1.0, low).otherwise(F.col("_gx"))).drop(
        "_gk", "_gt", "_gd", "_gm", "_gz", "_gu", "_gb", "_gv", "_gh", "_gx")
