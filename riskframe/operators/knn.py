"""Exact k-nearest neighbours inside one point set, in bounded blocks.

1. Vectors that repeat are collapsed (partial aggregation by vector), keeping the multiplicity and the ``k + 1``
   smallest ids, so a vector repeated millions of times is one row afterwards.
2. At most ``sqrt(n)`` pivots, a seeded sample, cut the space: a vector belongs to the cell of its nearest pivot. A
   range sort by (cell, distance to the pivot) packs each cell into blocks of at most ``block_bytes`` of
   coordinates; a block is a ring of its cell. Dense cells have more blocks, none is larger.
3. Per query a first bound comes from the pivots: some cell holds ``k + 1`` points within its first block's distance, so
   they are no farther than the distance to that pivot plus this one. By the triangle inequality only rings that meet the
   query's bound can hold a neighbour; a query block is joined, on the cell, to the rings that any of its queries needs.
4. A task streams the candidate blocks of a query block, nearest first, and merges each into the running ``k + 1`` best
   of every query. A block is skipped for the queries whose current k-th distance its ring does not meet. The block
   product ``|a|^2 + |b|^2 - 2ab`` picks the pairs that can enter, with the rounding error as slack; their distances
   are then computed directly, so results do not depend on the blocks.

A task holds one query block, one candidate block, the pivots and products of QUERY_CHUNK rows: about 3 * ``block_bytes``
+ 40 MB, whatever the number of points, copies or ties. The driver holds the pivots. Nothing is capped: in the worst case
(no ring can be left out) every query block meets every block, which an exact answer then needs.

Rows with a null id, a null or empty vector or null, NaN or infinite components take no part; all vectors must have one length.
Ties go to the smaller id. Points with the same id and different vectors each count.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import bounded_batches, checkpoint_root, stored

#: Coordinates of a block, in bytes.
BLOCK_BYTES = 2 << 20
#: Queries whose products with a block are held at once.
QUERY_CHUNK = 512
#: Pairs whose distances are computed at once.
PAIR_CHUNK = 1 << 15
NO_ID = np.iinfo(np.int64).max

BLOCKS = "block long, cell int, n int, lo double, hi double, near double, ids binary, m binary, vecs binary"


def _distinct_vectors(points: DataFrame, k: int) -> DataFrame:
    """(vec, m, ids): multiplicity and up to k+1 smallest ids per distinct vector.

    One more ``min`` round per extra id, and only as many rounds as the largest multiplicity
    needs (none when all vectors are distinct)."""
    base = stored(points.groupBy("vec").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("_t1")), "knn-vectors")
    small = base.select("vec", "m", F.array("_t1").alias("ids"), F.col("_t1").alias("_last"))
    max_m = base.agg(F.max("m")).first()[0] or 1
    dup = points.join(base.where(F.col("m") > 1).select("vec"), "vec", "left_semi")
    for _ in range(min(k, max_m - 1)):
        more = small.where(F.size("ids") < F.col("m")).select("vec", "_last")
        nxt = dup.join(more, "vec").where(F.col("id") > F.col("_last")).groupBy("vec").agg(F.min("id").alias("_n"))
        small = small.join(nxt, "vec", "left").select(
            "vec", "m",
            F.when(F.col("_n").isNull(), F.col("ids")).otherwise(F.concat("ids", F.array("_n"))).alias("ids"),
            F.coalesce("_n", "_last").alias("_last"),
        )
    return small.drop("_last")


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of all rows of ``a`` and ``b`` by products, and how far off they may be."""
    size = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
    off = 4 * (a.shape[1] + 8) * np.finfo(np.float64).eps * size
    square = np.maximum(size - 2.0 * (a @ b.T), 0.0)
    return np.sqrt(square), np.sqrt(off)


class _Pack:
    """Packs rows in order of (cell, distance) into blocks of at most ``size`` rows of one cell."""

    def __init__(self, size: int, k: int):
        self.size, self.k = size, k

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("ids").to_pylist()
            padded = np.full((len(ids), self.k + 1), NO_ID, np.int64)
            for i, own in enumerate(ids):
                padded[i, :len(own)] = own
            new = {"cell": batch.column("cell").to_numpy(zero_copy_only=False), "dist": batch.column("dist").to_numpy(zero_copy_only=False),
                   "m": batch.column("m").to_numpy(zero_copy_only=False), "ids": padded, "vec": _rows(batch.column("vec"))}
            held = {c: np.concatenate([held[c], v]) for c, v in new.items()} if held else new
            yield from self._cut(held, False)
        if held:
            yield from self._cut(held, True)

    def _cut(self, held: dict[str, np.ndarray], end: bool) -> Iterator[pa.RecordBatch]:
        while len(held["cell"]):
            cell = held["cell"]
            other = np.nonzero(cell[:self.size] != cell[0])[0]
            n = int(other[0]) if len(other) else min(len(cell), self.size)
            if n == len(cell) and n < self.size and not end:
                return
            own = {c: v[:n] for c, v in held.items()}
            for c in held:
                held[c] = held[c][n:]
            reached = np.cumsum(own["m"]) >= self.k + 1
            near = float(own["dist"][np.argmax(reached)]) if reached.any() else math.inf
            row = (int(own["ids"][0, 0]), int(own["cell"][0]), n, float(own["dist"].min()), float(own["dist"].max()), near,
                   own["ids"].tobytes(), own["m"].astype(np.int64).tobytes(), own["vec"].astype(np.float64).tobytes())
            types = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary())
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)


class _Best:
    """The running k + 1 best of the queries of one block."""

    def __init__(self, vecs: np.ndarray, ids: np.ndarray, k: int):
        self.vecs, self.own, self.keep = vecs, ids[:, 0], k + 1
        self.dist = np.full((len(vecs), self.keep), np.inf)
        self.ids = np.full((len(vecs), self.keep, k + 1), NO_ID, np.int64)

    def merge(self, x: np.ndarray, ids: np.ndarray, which: np.ndarray) -> None:
        """Candidates ``x`` for the queries ``which``."""
        size_x = (x * x).sum(axis=1)
        rel = 4 * (x.shape[1] + 8) * np.finfo(np.float64).eps
        wide = np.column_stack([x, size_x]).T  # one product gives |x|^2 - 2qx
        for at in range(0, len(which), QUERY_CHUNK):
            rows = which[at:at + QUERY_CHUNK]
            q = self.vecs[rows]
            size_q = (q * q).sum(axis=1)
            slack = 2 * rel * (size_q + size_x.max())
            less = np.column_stack([-2.0 * q, np.ones(len(q))]) @ wide
            limit = self.dist[rows, -1] ** 2 - size_q
            if x.shape[0] > self.keep:
                # a block bounds the queries that have no k + 1 points yet
                new = np.nonzero(np.isinf(limit))[0]
                if len(new):
                    limit[new] = np.partition(less[new], self.keep - 1, axis=1)[:, self.keep - 1]
            a, b = np.nonzero(less <= (limit + slack)[:, None])
            for cut in range(0, len(a), PAIR_CHUNK * 8):
                self._enter(rows, a[cut:cut + PAIR_CHUNK * 8], q, x, b[cut:cut + PAIR_CHUNK * 8], ids)

    def _enter(self, rows: np.ndarray, a: np.ndarray, q: np.ndarray, x: np.ndarray, b: np.ndarray, ids: np.ndarray) -> None:
        dist = np.concatenate([np.sqrt(((q[a[i:i + PAIR_CHUNK]] - x[b[i:i + PAIR_CHUNK]]) ** 2).sum(axis=1))
                               for i in range(0, len(a), PAIR_CHUNK)])
        met, back = np.unique(a, return_inverse=True)
        mine = rows[met]
        n, k1 = len(met), self.ids.shape[2]
        all_row = np.concatenate([np.repeat(np.arange(n), self.keep), back])
        all_dist = np.concatenate([self.dist[mine].ravel(), dist])
        first = np.concatenate([self.ids[mine][:, :, 0].ravel(), ids[b, 0]])
        order = np.lexsort((first, all_dist, all_row))
        start = np.searchsorted(all_row[order], np.arange(n))
        take = order[start[:, None] + np.arange(self.keep)]
        old = n * self.keep
        kept = np.where((take < old)[:, :, None], self.ids[mine].reshape(old, k1)[np.minimum(take, old - 1)],
                        ids[b[np.maximum(take - old, 0)]])
        self.dist[mine], self.ids[mine] = all_dist[take], kept

    def rows(self) -> pa.RecordBatch:
        """(rep, seq): the k + 1 nearest (distance, id) pairs, the point itself included."""
        n, keep, k1 = self.ids.shape
        flat, dist = self.ids.reshape(n, keep * k1), np.repeat(self.dist, k1, axis=1)
        order = np.lexsort((flat, np.where(flat == NO_ID, np.inf, dist)), axis=1)[:, :keep]
        flat, dist = np.take_along_axis(flat, order, 1), np.take_along_axis(dist, order, 1)
        real = flat != NO_ID
        pairs = pa.StructArray.from_arrays([pa.array(dist[real]), pa.array(flat[real])], ["dist", "nbr_id"])
        offsets = np.concatenate([[0], np.cumsum(real.sum(axis=1))]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(self.own), pa.ListArray.from_arrays(pa.array(offsets), pairs)], names=["rep", "seq"])


def _unpacked(batch: pa.RecordBatch, i: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.column("n")[i].as_py()
    ids = np.frombuffer(batch.column("ids")[i].as_buffer(), np.int64).reshape(n, k + 1)
    return np.frombuffer(batch.column("vecs")[i].as_buffer(), np.float64).reshape(n, -1), ids


def exact_knn(points: DataFrame, id_col: str, vec_col: str, k: int = 5, block_bytes: int = BLOCK_BYTES, seed: int = 42) -> DataFrame:
    """(id, rank, nbr_id, dist): the k nearest other points of every point (fewer if there are not so many), ties by id."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Python workers need not have the package
    spark = points.sparkSession
    checkpoint_root(spark)
    bounded_batches(spark)
    pts = points.select(F.col(id_col).cast("bigint").alias("id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    pts = pts.where(F.col("id").isNotNull() & (F.size("vec") > 0) & ~bad)
    distinct = _distinct_vectors(pts, k).withColumn("rep", F.get("ids", F.lit(0)))
    count, dims, least = distinct.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.min(F.size("vec"))).first()
    if count and dims != least:
        raise ValueError("vectors of different lengths")
    size = max(1, block_bytes // (8 * max(dims or 1, 1)))
    n_pivots = max(1, math.ceil(min(count / size, math.sqrt(count))))
    drawn = distinct.orderBy(F.xxhash64(F.lit(seed), F.col("rep")), "vec").limit(n_pivots).select("vec").collect()
    pivots = spark.sparkContext.broadcast(np.array([r.vec for r in drawn] or [[0.0]], np.float64))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_CHUNK):
                part = batch.slice(at, QUERY_CHUNK)
                vecs = _rows(part.column("vec"))
                cell = _distances(vecs, pivots.value)[0].argmin(axis=1)
                dist = np.sqrt(((vecs - pivots.value[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(dist)],
                                                 names=[*part.schema.names, "cell", "dist"])

    placed = distinct.select("vec", "m", "ids").mapInArrow(cells, "vec array<double>, m long, ids array<long>, cell int, dist double")
    key = F.get("ids", F.lit(0)).alias("rep")
    placed = placed.select("*", key).repartitionByRange("cell", "dist", "rep").sortWithinPartitions("cell", "dist", "rep")
    blocks = stored(placed.mapInArrow(_Pack(size, k), BLOCKS), "knn-blocks")
    rings = blocks.groupBy("cell").agg(F.min("lo"), F.max("hi"), F.min("near")).collect()  # at most a row for each pivot
    inner, outer, near = (np.full(max(len(drawn), 1), v) for v in (np.inf, -np.inf, np.inf))
    for cell, lo, hi, close in rings:
        inner[cell], outer[cell], near[cell] = lo, hi, close
    rings = spark.sparkContext.broadcast((inner, outer, near))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, close = rings.value
        for batch in batches:
            for i in range(batch.num_rows):
                vecs = np.frombuffer(batch.column("vecs")[i].as_buffer(), np.float64).reshape(batch.column("n")[i].as_py(), -1)
                a, b, bound = np.full(len(first), np.inf), np.full(len(first), -np.inf), np.full(len(first), np.inf)
                for at in range(0, len(vecs), QUERY_CHUNK):
                    dist, off = _distances(vecs[at:at + QUERY_CHUNK], pivots.value)
                    theta = (dist + off + close).min(axis=1, keepdims=True)
                    low, high = dist - off - theta, dist + off + theta
                    needs = (low <= last) & (high >= first)
                    a = np.minimum(a, np.where(needs, low, np.inf).min(axis=0))
                    b = np.maximum(b, np.where(needs, high, -np.inf).max(axis=0))
                    gap = np.maximum(np.maximum(dist - last, first - dist), 0.0)
                    bound = np.minimum(bound, np.where(needs, gap, np.inf).min(axis=0))
                met = np.nonzero(a <= b)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(met), batch.column("block")[i].as_py())), pa.array(met.astype(np.int32)),
                     pa.array(a[met]), pa.array(b[met]), pa.array(bound[met])], names=["query", "cell", "a", "b", "bound"])

    reached = blocks.select("block", "n", "vecs").mapInArrow(reach, "query long, cell int, a double, b double, bound double")
    pairs = reached.join(blocks.select("block", "cell", "lo", "hi"), "cell").where(
        (F.col("lo") <= F.col("b")) & (F.col("hi") >= F.col("a")) & (F.col("query") != F.col("block"))).select("query", "block", "bound")
    candidates = pairs.join(blocks, "block").select("query", F.lit(1).alias("role"), "bound", *[c for c in blocks.columns if c not in ("near", "m")])
    queries = blocks.select(F.col("block").alias("query"), F.lit(0).alias("role"), F.lit(0.0).alias("bound"), *candidates.columns[3:])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            for i in range(batch.num_rows):
                x, ids = _unpacked(batch, i, k)
                if batch.column("role")[i].as_py() == 0:
                    if best is not None:
                        yield best.rows()
                    best = _Best(x, ids, k)
                    best.merge(x, ids, np.arange(len(x)))
                    continue
                cell, lo, hi = (batch.column(c)[i].as_py() for c in ("cell", "lo", "hi"))
                dist, off = _distances(best.vecs, pivots.value[cell:cell + 1])
                low = np.maximum(dist - hi, lo - dist)[:, 0] - off[:, 0]
                best.merge(x, ids, np.nonzero(low <= best.dist[:, -1])[0])
        if best is not None:
            yield best.rows()

    ordered = queries.unionByName(candidates).repartition("query").sortWithinPartitions("query", "role", "bound", "block")
    seqs = ordered.mapInArrow(search, "rep long, seq array<struct<dist: double, nbr_id: bigint>>")

    vec_seq = distinct.select("vec", "rep").join(seqs, "rep").select("vec", "seq")
    joined = pts.join(vec_seq, "vec")
    mine = F.slice(F.filter(F.col("seq"), lambda s: s["nbr_id"] != F.col("id")), 1, k)
    return joined.select("id", F.posexplode(mine).alias("pos", "s")).select(
        "id", (F.col("pos") + 1).cast("bigint").alias("rank"), F.col("s.nbr_id").alias("nbr_id"), F.col("s.dist").alias("dist"))
