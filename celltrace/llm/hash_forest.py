"""Approximate nearest neighbours by a hash-prefix forest (LSH Forest; Bawa, Condie and Ganesan, 2005).

Vectors are spread over shards of about ``SHARD_ROWS`` rows. A shard is one row of the index table: its ids, its vectors and, per
tree, a sorted array of 64-bit hash strings (signs of random projections around the shard's mean). A query descends
in every tree to the longest prefix that it shares with a neighbour in the sorted array, then all trees ascend together,
one bit at a time, until the prefixes cover enough entries; the union of these ranges is scored exactly.

The queries are a stated set, sent to the shards in blocks; each shard answers with its nearest rows, and the
answers are merged. No pair of a query and a row is ever a row of a table, and no bucket has a cap: a prefix that is
shared by a whole shard is a range like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celltrace.llm.scratch import Scratch

SHARD_ROWS = 8192
QUERY_BLOCK = 128
#: Trees of a shard, and entries of all trees together, as a multiple of the shard's rows, that the ascent asks for. Set for a
#: recall of 0.95 and more on vectors with hardly any structure, where true neighbours share few bits.
TREES, BREADTH = 48, 1.25
_BITS = 64


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def projections(dim: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, trees * _BITS))


def hash_strings(vectors: np.ndarray, mean: np.ndarray, planes: np.ndarray, trees: int) -> np.ndarray:
    """One 64-bit string per tree (row) and vector (column), the first sign in the highest bit."""
    out = np.empty((trees, len(vectors)), np.uint64)
    for at in range(0, len(vectors), 1024):
        signs = (vectors[at : at + 1024] - mean) @ planes > 0
        packed = np.packbits(signs.reshape(-1, trees, _BITS), axis=2)
        out[:, at : at + 1024] = np.ascontiguousarray(packed).view(">u8")[:, :, 0].T
    return out


class Shard:
    """Sorted hash strings of all trees over the vectors of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, labels: np.ndarray, order: np.ndarray):
        self.ids, self.vectors, self.labels, self.order = ids, vectors, labels, order
        self.mean, self.single = vectors.mean(axis=0), vectors.astype(np.float32)
        self.norms = (self.single * self.single).sum(axis=1)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, planes: np.ndarray, trees: int) -> Shard:
        labels = hash_strings(vectors, vectors.mean(axis=0), planes, trees)
        order = np.argsort(labels, axis=1, kind="stable").astype(np.int32)
        return cls(ids, vectors, np.take_along_axis(labels, order, axis=1), order)

    def _depths(self, strings: np.ndarray) -> np.ndarray:
        """Longest prefix, over all trees, that each query shares with a neighbour in the sorted arrays."""
        best = np.zeros(strings.shape[1], np.int64)
        for labels, wanted in zip(self.labels, strings):
            place = np.searchsorted(labels, wanted)
            for near in (np.maximum(place - 1, 0), np.minimum(place, len(labels) - 1)):
                differ = labels[near] ^ wanted
                high = np.frexp((differ >> np.uint64(11)).astype(np.float64))[1]
                depth = np.where(high > 0, 53 - high, np.where(differ == 0, _BITS, 53))
                best = np.maximum(best, depth)
        return best

    def candidates(self, strings: np.ndarray, asked: int) -> Iterator[tuple[int, np.ndarray]]:
        """Place of a query and its rows, when the ascent of all its trees has covered ``asked`` entries."""
        depth, todo = self._depths(strings), np.arange(strings.shape[1])
        for level in range(int(depth.max(initial=0)), -1, -1):
            here = todo[depth[todo] >= level]
            if not len(here):
                continue
            shift = np.uint64(_BITS - level)
            low, high = np.zeros((2, len(strings), len(here)), np.int64)
            for tree, (labels, wanted) in enumerate(zip(self.labels, strings[:, here])):
                if level == 0:
                    high[tree] = len(labels)
                    continue
                first = wanted if level == _BITS else (wanted >> shift) << shift
                last = first if level == _BITS else first | ((np.uint64(1) << shift) - np.uint64(1))
                low[tree], high[tree] = np.searchsorted(labels, first, "left"), np.searchsorted(labels, last, "right")
            enough = (high - low).sum(axis=0) >= asked
            if level == 0:
                enough[:] = True
            for i in np.flatnonzero(enough):
                marked = np.zeros(len(self.ids), bool)
                for tree in range(len(strings)):
                    marked[self.order[tree, low[tree, i] : high[tree, i]]] = True
                yield int(here[i]), np.flatnonzero(marked)
            todo = np.setdiff1d(todo, here[enough])

    def nearest(self, rows: np.ndarray, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the ``k`` nearest of some rows: single precision picks, double precision decides."""
        rows = rows[self.ids[rows] != own]
        if not len(rows):
            return self.ids[:0], np.empty(0)
        if len(rows) > k:
            single = query.astype(np.float32)
            rough = self.norms[rows] - 2 * (self.single[rows] @ single)
            slack = 1e-4 * (1 + float(self.norms[rows].max()) + float(single @ single))
            if np.isfinite(slack) and np.isfinite(rough).all():
                rows = rows[rough <= np.partition(rough, k - 1)[k - 1] + slack]
        exact = np.sqrt(((self.vectors[rows] - query) ** 2).sum(axis=1))
        first = np.lexsort((self.ids[rows], exact))[:k]
        return self.ids[rows][first], exact[first]


def points(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``(id, dim, v)`` of all vectors that take part; rows that share an id count once, with the vector of the smallest hash."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    return rows.groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v")).select("id", F.size("v").alias("dim"), "v")


def build_forest(scratch: Scratch, rows: DataFrame, trees: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The index table (one row per shard) and ``(dim, shards)``. Every row of ``rows(id, dim, v)`` is in it."""
    sizes = scratch.cut(rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards")), "sizes")
    placed = rows.join(sizes, "dim").select("dim", F.pmod(F.xxhash64("id"), "shards").cast("int").alias("shard"), "id", "v")
    schema = "dim int, shard int, ids binary, vectors binary, labels binary, places binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None

        def shard() -> pa.RecordBatch:
            ids = np.concatenate([h[0] for h in held])
            vectors = np.concatenate([h[1] for h in held]).reshape(len(ids), -1)
            built = Shard.build(ids, vectors, projections(vectors.shape[1], trees, seed), trees)
            data = [pa.array([x.tobytes()], pa.binary()) for x in (ids, vectors, built.labels, built.order)]
            return pa.RecordBatch.from_arrays([pa.array([current[0]], pa.int32()), pa.array([current[1]], pa.int32()), *data], ["dim", "shard", "ids", "vectors", "labels", "places"])

        for batch in batches:
            dims, shards = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if (dims[a], shards[a]) != current:
                    if held:
                        yield shard()
                    held, current = [], (dims[a], shards[a])
                held.append((batch.column(2).slice(a, b - a).to_numpy(), np.asarray(batch.column(3).slice(a, b - a).flatten())))
        if held:
            yield shard()

    table = placed.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "id").mapInArrow(run, schema)
    return scratch.cut(table, "forest"), sizes


def search(
    vectors: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id", vector: str = "embedding", trees: int = TREES, breadth: float = BREADTH, seed: int = 17
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for every row that ``queries`` (a condition on ``id``)
    selects, by Euclidean distance in double precision, ties to the smaller id.

    Rows without an id and vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors are
    compared with those of the same length. Where a shard has few rows the ascent reaches its root, so small tables are searched whole.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.cut(points(vectors, id_column, vector), "points")
    forest, sizes = build_forest(scratch, rows, trees, seed)
    asked = rows.filter(queries).join(sizes, "dim").select("dim", "id", "v", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    none = F.lit(None).cast("binary")
    mixed = forest.select("dim", "shard", F.lit(0).alias("role"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("v"), "ids", "vectors", "labels", "places")
    mixed = mixed.unionByName(asked.select("dim", "shard", F.lit(1).alias("role"), "id", "v", *(none.alias(c) for c in ("ids", "vectors", "labels", "places"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, waiting = None, []

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            if not waiting or shard is None:
                waiting = []
                return
            block = np.stack([v for _, v in waiting])
            strings = hash_strings(block, shard.mean, projections(block.shape[1], trees, seed), trees)
            need = max(int(np.ceil(breadth * len(shard.ids))), trees * (k + 1))
            out = [(waiting[i][0], *shard.nearest(found, waiting[i][0], block[i], k)) for i, found in shard.candidates(strings, need)]
            waiting = []
            names = np.concatenate([np.full(len(i), q) for q, i, _ in out]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate([i for _, i, _ in out])), pa.array(np.concatenate([d for *_, d in out]))], ["query_id", "vec_id", "score"])

        for batch in batches:
            roles, ids = batch.column(2).to_numpy(), batch.column(3)
            for i in range(batch.num_rows):
                if roles[i] == 0:
                    yield from answer()
                    ids_, vectors_, labels, places = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in ((5, np.int64), (6, np.float64), (7, np.uint64), (8, np.int32)))
                    shard = Shard(ids_, vectors_.reshape(len(ids_), -1), labels.reshape(trees, -1), places.reshape(trees, -1))
                else:
                    waiting.append((ids[i].as_py(), np.asarray(batch.column(4)[i].values)))
                    if len(waiting) == QUERY_BLOCK:
                        yield from answer()
        yield from answer()

    found = mixed.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "role").mapInArrow(run, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
