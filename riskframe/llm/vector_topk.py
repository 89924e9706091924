"""Exact top-k search by inner product with a vector-approximation file.

Vectors become integers floor(scale * x). Every component is approximated by a cell of ``cell``
integers, so a scan of the cells bounds the inner product from above, and, as all cells are
equally wide, from below by the same bound less a constant of the query. First scan: the k
largest upper bounds of each query, which give its threshold (their k-th, less that constant).
Second scan: only vectors whose upper bound reaches the threshold are looked at, exact vectors
read in the order of falling bounds until the k-th exact score is above the next bound; the
blocks' best rows are then merged. Queries meet all rows in blocks: vectors are packed into
groups, and every block of queries visits every group. The visits are a product of the stored
groups and blocks: a task reads its files of either side again, and nothing is repeated by an
explode, shuffled or broadcast for them.

Vectors that are null or hold a null or non-finite component take no part, nor do rows with a
null id. Rows repeating an id count once (the smallest vector of that id). A vector meets only
those of its own length. Ties go to the smaller id; fewer than k others: all of them. Empty
table: no rows. Further columns are ignored. Scores that could reach 2**53 raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, shuffled, store

GROUP_ROWS = 8_192
QUERY_ROWS = 1_024


def _bytes(a: np.ndarray) -> bytes:
    """The matrix in the narrowest of 1, 2 or 8 bytes a value."""
    top = np.abs(a).max(initial=0)
    return a.astype("<i1" if top < 128 else "<i2" if top < 32_768 else "<i8").tobytes()


def _matrix(raw: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{len(raw) // (rows * dim)}" if raw else "<i8").reshape(rows, dim).astype(np.int64)


def _packed(df: DataFrame, n_groups: int, cell: int) -> DataFrame:
    """One row per group and vector length: ids, the approximation (cell numbers) and the exact vectors as bytes."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}

        def out(key):
            ids, vecs = zip(*held.pop(key))
            exact = np.array(vecs, "<i8").reshape(len(ids), key[1])
            return pd.DataFrame({"grp": [key[0]], "dim": [key[1]], "ids": [np.array(ids, "<i8").tobytes()],
                                 "cells": [_bytes(exact // cell)], "vecs": [_bytes(exact)]})

        for b in batches:
            for g, i, v in zip(b["grp"], b["id"], b["v"]):
                held.setdefault((g, len(v)), []).append((i, v))
                if len(held[(g, len(v))]) >= GROUP_ROWS:
                    yield out((g, len(v)))
        for key in list(held):
            yield out(key)

    dealt = df.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(n_groups)).cast("int")).repartition(n_groups, "grp")
    return dealt.select("grp", "id", "v").mapInPandas(pack, "grp int, dim int, ids binary, cells binary, vecs binary")


def _bounds(q: np.ndarray, cells: np.ndarray, cell: int) -> np.ndarray:
    """Upper bounds of the inner products: a positive query component meets a cell's upper end, a negative one its lower."""
    low = (cells * cell).astype(np.float64)
    qf = q.astype(np.float64)
    return qf @ low.T + (np.clip(qf, 0, None).sum(axis=1) * (cell - 1))[:, None]


def _exact(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    top = float(np.abs(q).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, len(q))
    if top >= 2.0**53:
        raise OverflowError("inner products of 2**53 and more are not supported")
    return rows @ q


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, cell: int = 2,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score) of every row for which ``is_query`` (on ``id``) holds."""
    v = F.col("v")
    ints = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where("id is not null and v is not null")
            .where(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")))
            .groupBy("id").agg(F.min("v").alias("v")))
    ints = store(ints, "integer-vectors")
    queries = ints.where(is_query)
    n_groups, q_groups = (max(1, -(-d.count() // n)) for d, n in ((ints, GROUP_ROWS // 2), (queries, QUERY_ROWS // 2)))
    groups = store(_packed(ints, n_groups, cell), "vector-groups")
    blocks = store(_packed(queries, q_groups, cell).select(
        F.col("grp").alias("q_grp"), "dim", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")), "query-blocks")
    bounded_batches(vectors.sparkSession)

    def visited(groups: DataFrame, blocks: DataFrame) -> DataFrame:
        return groups.join(blocks.hint("shuffle_replicate_nl"), "dim")

    def unpack(ids, raw, dim):
        i = np.frombuffer(ids, "<i8")
        return i, _matrix(raw, len(i), dim)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples(index=False):
                (qi, q), (ci, cells) = unpack(row.q_ids, row.q_vecs, row.dim), unpack(row.ids, row.cells, row.dim)
                for at in range(0, len(qi), 256):
                    up = _bounds(q[at:at + 256], cells, cell)
                    up[qi[at:at + 256, None] == ci[None, :]] = -np.inf
                    n = min(k, up.shape[1])
                    best = -np.partition(-up, n - 1, axis=1)[:, :n]
                    yield pd.DataFrame({"id": np.repeat(qi[at:at + 256], n), "up": best.ravel()})

    pairs = visited(groups.drop("vecs"), blocks)  # the first scan reads approximations only
    ups = pairs.mapInPandas(scan, "id long, up double").where("up > double('-Infinity')")
    nth = F.row_number().over(_by("id", F.desc("up")))
    slack = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.abs(x).cast("double")) * (cell - 1)
    limits = (ups.withColumn("n", nth).where(F.col("n") <= k).groupBy("id")
              .agg(F.when(F.count("*") >= k, F.min("up")).alias("kth"))
              .join(shuffled(queries), "id").select("id", (F.col("kth") - slack).alias("least"), F.size("v").alias("dim")))
    limits = store(limits
                   .withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(q_groups)).cast("int")), "thresholds")
    per_block = limits.groupBy(F.col("grp").alias("q_grp"), "dim").agg(
        F.collect_list("id").alias("l_ids"), F.collect_list(F.coalesce("least", F.lit(float("-inf")))).alias("l_min"))

    def refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples(index=False):
                (qi, q), (ci, cells) = unpack(row.q_ids, row.q_vecs, row.dim), unpack(row.ids, row.cells, row.dim)
                c = _matrix(row.vecs, len(ci), row.dim)
                least = dict(zip(row.l_ids, row.l_min))
                out: list[tuple] = []
                for at in range(0, len(qi), 256):
                    up = _bounds(q[at:at + 256], cells, cell)
                    for j, qid in enumerate(qi[at:at + 256].tolist()):
                        near = np.flatnonzero((up[j] >= least.get(qid, np.inf)) & (ci != qid))
                        near = near[np.argsort(-up[j][near], kind="stable")]
                        kept_id, kept = np.empty(0, np.int64), np.empty(0, np.int64)
                        for s in range(0, len(near), 64):
                            if len(kept) >= k and kept[k - 1] > up[j][near[s]]:
                                break  # no later vector can reach the k-th score, nor tie with it
                            part = near[s:s + 64]
                            kept_id, kept = np.r_[kept_id, ci[part]], np.r_[kept, _exact(q[at + j], c[part])]
                            order = np.lexsort((kept_id, -kept))[:k]
                            kept_id, kept = kept_id[order], kept[order]
                        out += zip([qid] * len(kept), kept_id.tolist(), kept.tolist())
                yield pd.DataFrame(out, columns=["query_id", "id", "score"])

    limited = store(blocks.join(shuffled(per_block), ["q_grp", "dim"]), "limited-blocks")
    found = (visited(groups, limited)
             .mapInPandas(refine, "query_id long, id long, score long"))
    rank = F.row_number().over(_by("query_id", F.desc("score"), F.asc("id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def _by(part: str, *order):
    from pyspark.sql import Window

    return Window.partitionBy(part).orderBy(*order)
