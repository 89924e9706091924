"""SMOTE: synthetic minority rows x + u * (neighbour - x), up to class parity.

Neighbours come from :func:`riskframe.operators.knn.exact_knn`. The number of synthetic rows
per minority row follows from two counts (no driver loop over rows): with ``n_syn`` rows
needed and ``n_min`` minority rows, row number i (a bijection 1..n_min from
:func:`riskframe.operators.assign.index_within_group`) makes ``n_syn // n_min`` rows, plus
one when ``i <= n_syn % n_min``. Neighbour choice and gap are seeded by (row id, copy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import seeded
from riskframe.operators.assign import index_within_group
from riskframe.operators.knn import exact_knn
from riskframe.operators.sampling import COPIES_AT_ONCE


def smote(points: DataFrame, id_col: str, vec_col: str, label_col: str, minority_label, k: int = 5,
          seed: int = 42, digits: int | None = None) -> DataFrame:
    """(base_id, copy, nbr_id, gap, syn_vec) for the synthetic minority rows; none with fewer than two minority rows."""
    pts = points.select(F.col(id_col).cast("bigint").alias("id"),
                        F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vec"),
                        (F.col(label_col) == F.lit(minority_label)).alias("is_min"))
    counts = pts.agg(F.sum(F.col("is_min").cast("long")).alias("n_min"),
                     F.sum((~F.col("is_min")).cast("long")).alias("n_maj"))
    minority = pts.where("is_min").select("id", "vec")
    nn = exact_knn(minority, "id", "vec", k)
    idx = index_within_group(minority.select(F.lit(1).alias("g"), "id"), "g", "id").select("id", "idx")
    n_syn = F.greatest(F.col("n_maj") - F.col("n_min"), F.lit(0))
    per = idx.crossJoin(F.broadcast(counts)).select(
        "id", "n_min",
        (F.floor(n_syn / F.col("n_min")) + F.when(F.col("idx") <= n_syn % F.col("n_min"), 1).otherwise(0)).cast("bigint").alias("c"),
    )
    # in two steps, so no row holds an array of all its copies
    step = F.lit(COPIES_AT_ONCE).cast("bigint")
    runs = per.where((F.col("c") > 0) & (F.col("n_min") > 1)).select(
        "id", "n_min", "c", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("c"), step)).alias("from"))
    rows = runs.select("id", "n_min", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + step - 1, F.col("c")))).alias("copy"))
    key = seeded.compound_key("id", "copy")
    k_eff = F.least(F.lit(k), F.col("n_min") - 1)
    rows = rows.select("id", "copy", seeded.randint(f"smnb{seed}", key, F.lit(1), k_eff).cast("bigint").alias("rank"),
                       seeded.uniform(f"smgap{seed}", key).alias("gap"))
    with_nbr = rows.join(nn.select("id", "rank", "nbr_id"), ["id", "rank"])
    base = minority.select(F.col("id"), F.col("vec").alias("bvec"))
    nbr = minority.select(F.col("id").alias("nbr_id"), F.col("vec").alias("nvec"))
    j = with_nbr.join(base, "id").join(nbr, "nbr_id")
    syn = F.zip_with("bvec", "nvec", lambda a, b: a + F.col("gap") * (b - a))
    if digits is not None:
        syn = F.transform(syn, lambda x: F.round(x.cast("decimal(38,10)"), digits).cast("double"))
    return j.select(F.col("id").alias("base_id"), F.col("copy").cast("bigint").alias("copy"), "nbr_id", "gap",
                    syn.alias("syn_vec"))
