"""Centroid clustering in integers, with a vantage-point tree over the centroids.

Every round builds a vantage-point tree of the centroids and broadcasts it. A vector searches it best first: it takes the open
node with the smallest lower bound, measures its centroids exactly, and opens those children whose ring of distances can still hold a
centroid as near as the best one, a tie included. The vectors of a batch do so side by side, each with its own queue. Distances are exact
integers; radii are kept as whole numbers below and above the true root, so no rounding can prune a tie. Ties go to the smaller number.

The tasks add up their vectors by cluster, a grouped sum joins the tasks, and the driver only sees one vector per cluster.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm.scratch import Scratch

#: Centroids of a leaf; numbers in all centroids together (they are broadcast); numbers that a task compares at once.
LEAF, MODEL_LIMIT, STEP = 2, 1 << 24, 1 << 20
_LIMB = 10**18


@dataclass
class Node:
    """Members of a leaf, or a vantage point with two children and the ring of distances that each lies in."""

    members: list[int]
    children: tuple[int, int] = ()
    rings: tuple[tuple[int, int], tuple[int, int]] = ()


def roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers not above and not below the roots of integers."""
    if squares.dtype == object:
        low = np.frompyfunc(math.isqrt, 1, 1)(squares)
        return low, low + 1
    low = np.sqrt(squares.astype(np.float64)).astype(np.int64)  # off by one at most
    return np.maximum(low - 1, 0), low + 2


class Tree:
    """Vantage-point tree of integer centroids; ``search`` gives each row's nearest one and its squared distance."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids, self.nodes = centroids, []
        self._build(list(range(len(centroids))), leaf)

    def _build(self, members: list[int], leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(members))
        if len(members) > leaf:
            point, others = members[0], members[1:]
            squares = squared(self.centroids[others], self.centroids[point])
            order = sorted(range(len(others)), key=lambda i: (squares[i], others[i]))
            low, high = roots(squares)
            halves = order[: len(order) // 2], order[len(order) // 2 :]
            halves = [h for h in halves if h]
            rings = tuple((int(min(low[i] for i in h)), int(max(high[i] for i in h))) for h in halves)
            children = tuple(self._build([others[i] for i in h], leaf) for h in halves)
            self.nodes[at] = Node([point], children, rings)
        return at

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid, and how many distances were measured."""
        n, measured = len(rows), 0
        best = np.full(n, -1, np.int64)
        least = np.zeros(n, rows.dtype)
        # queues: lower bounds of the open nodes, -1 where a place is empty; the root has bound 0
        bounds, places = np.full((n, 4), -1, rows.dtype), np.zeros((n, 4), np.int64)
        bounds[:, 0], filled, live = 0, 1, np.arange(n)
        while len(live):
            queue = bounds[live, :filled]
            nearest = np.where(queue < 0, queue.max() + 1, queue)
            slot = nearest.argmin(axis=1)
            bound = queue[np.arange(len(live)), slot]
            # inclusive: a node whose bound equals the best distance may hold a tie
            go = (bound >= 0) & ((best[live] < 0) | (bound * bound <= least[live]))
            live, slot = live[go], slot[go]
            node, bound = places[live, slot], bound[go]
            bounds[live, slot] = -1
            if filled + 2 > bounds.shape[1]:
                bounds = np.concatenate([bounds, np.full_like(bounds, -1)], axis=1)
                places = np.concatenate([places, np.zeros_like(places)], axis=1)
            for number in np.unique(node):
                here = self.nodes[number]
                mine, above = live[node == number], bound[node == number]
                for c in here.members:
                    square = squared(rows[mine], self.centroids[c])
                    measured += len(mine)
                    nearer = (best[mine] < 0) | (square < least[mine]) | ((square == least[mine]) & (c < best[mine]))
                    best[mine[nearer]], least[mine[nearer]] = c, square[nearer]
                if here.children:
                    low, high = roots(square)
                    for k, (child, (inner, outer)) in enumerate(zip(here.children, here.rings)):
                        bounds[mine, filled + k] = np.maximum(np.maximum(low - outer, inner - high), above)
                        places[mine, filled + k] = child
            filled += 2
            used = np.flatnonzero((bounds[live, :filled] >= 0).any(axis=0)) if len(live) else []
            if len(used) < filled // 2:  # close the gaps
                width = max(len(used), 1)
                packed, where = np.full_like(bounds, -1), np.zeros_like(places)
                packed[:, : len(used)], where[:, : len(used)] = bounds[:, used], places[:, used]
                bounds, places, filled = packed, where, width
        return best, least, measured


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances; the caller sees to it that they fit."""
    gap = rows - point
    return (gap * gap).sum(axis=1)


def fits(values: np.ndarray) -> bool:
    """Whether squared distances among integers of this size are 64-bit numbers."""
    if not values.size:
        return True
    limit = math.isqrt(((1 << 62) - 1) // max(values.shape[-1], 1)) // 2
    return bool(values.max() <= limit and values.min() >= -limit)


def quantise(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of finite doubles as exact integers: 64-bit ones where their distances fit, else numbers of any size."""
    limit = float(1 << 40) / scale
    if (np.abs(values) < limit).all() and scale & (scale - 1) == 0:
        whole = np.floor(values * scale).astype(np.int64)  # a power of two rounds nothing
        if fits(whole):
            return whole
    exact = np.frompyfunc(lambda x: math.floor(scale * int(x)) if x == int(x) else _floor(x, scale), 1, 1)
    return exact(values).astype(object)


def _floor(x: float, scale: int) -> int:
    top, bottom = float(x).as_integer_ratio()
    return top * scale // bottom


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` components, none null and all finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dim) & finite, F.lit(False))


def _rows(batch: pa.RecordBatch, column: int, dim: int, k: int, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a batch as integer matrices, so small that their queues stay small as well."""
    step = max(1, STEP // max(dim, 2 * k))
    for at in range(0, batch.num_rows, step):
        part = batch.column(column).slice(at, step)
        yield at, quantise(np.asarray(part.flatten(), np.float64).reshape(-1, dim), scale)


def _nearest(tree: Tree, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if rows.dtype != tree.centroids.dtype:
        rows = rows.astype(object)
        tree = tree if tree.centroids.dtype == object else Tree(tree.centroids.astype(object))
    return tree.search(rows)[:2]


def _limbs(value: int) -> list[int]:
    """A number in pieces that sums of 38 digits can add up."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value or not out:
        value, low = divmod(value, _LIMB)
        out.append(sign * low)
    return out


def cluster_sums(vectors: DataFrame, tree, k: int, dim: int, scale: int) -> DataFrame:
    """``(cluster, place, limb, total)``: members (place -1) and componentwise sums of the clusters of ``vectors(id, v)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), object), np.zeros(k, np.int64)
        for batch in batches:
            for _, rows in _rows(batch, 1, dim, k, scale):
                best, _ = _nearest(tree.value, rows)
                for c in np.unique(best):
                    mine = rows[best == c]
                    counts[c] += len(mine)
                    sums[c] += mine.sum(axis=0)  # at most 2**20 numbers below 2**31 in size, or exact ones
        out = []
        for c in np.flatnonzero(counts):
            out.append((int(c), -1, 0, int(counts[c])))
            out += [(int(c), j, i, limb) for j in range(dim) for i, limb in enumerate(_limbs(int(sums[c, j])))]
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())], ["cluster", "place", "limb", "part"])

    parts = vectors.select("id", "v").mapInArrow(run, "cluster int, place int, limb int, part long")
    return parts.groupBy("cluster", "place", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))


def packed(centroids: list[list[int]]) -> np.ndarray:
    """Centroids as 64-bit integers where their distances fit."""
    exact = np.array(centroids, dtype=object).reshape(len(centroids), -1)
    return exact.astype(np.int64) if fits(exact) else exact


def cluster_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", dim: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3, scratch: Scratch | None = None,
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per usable row of ``vectors``.

    Usable vectors have ``dim`` components, none null, all finite; component x becomes the integer floor(scale * x). The first centroids are
    the vectors with the smallest SHA-256 of ``seed:id``, equal ones by their components, null ids last; with fewer than ``k`` rows there
    are fewer clusters, without a row there is no result. Each of the rounds assigns every vector and moves every centroid that has
    members to their mean, rounded down; then all are assigned once more. Repeated rows count each. A distance, or a sum of distances,
    above 2**63 - 1 is null; the assignment stays exact. Other columns of ``vectors`` are not read.
    """
    if k * dim > MODEL_LIMIT:
        raise ValueError(f"{k} centroids of {dim} components: the tree is broadcast and holds at most {MODEL_LIMIT} numbers")
    scratch = scratch or Scratch(vectors.sparkSession)
    sc = scratch.spark.sparkContext
    plain = F.col(vector).cast("array<double>")
    rows = scratch.cut(vectors.filter(usable(plain, dim)).select(F.col(id_column).alias("id"), plain.alias("v")), "vectors")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select("v", named.alias("hash")).orderBy(F.asc_nulls_last("hash"), "v").limit(k).collect()
    centroids = [quantise(np.array([r["v"]], float), scale)[0].tolist() for r in first]
    for _ in range(rounds if centroids else 0):
        tree = sc.broadcast(Tree(packed(centroids)))
        found: dict[tuple[int, int], int] = {}
        for r in cluster_sums(rows, tree, len(centroids), dim, scale).collect():  # a number per cluster and component
            at = r["cluster"], r["place"]
            found[at] = found.get(at, 0) + int(r["total"]) * _LIMB ** r["limb"]
        tree.destroy()
        centroids = [[found[c, j] // found[c, -1] for j in range(dim)] if (c, -1) in found else old for c, old in enumerate(centroids)]
    tree = sc.broadcast(Tree(packed(centroids)) if centroids else None)
    schema = T.StructType([rows.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in _rows(batch, 1, dim, k, scale):
                best, least = _nearest(tree.value, part)
                far = [x if x < 1 << 63 else None for x in least.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(best, pa.int32()), pa.array(far, pa.int64())], schema.names)

    assigned = scratch.cut(rows.mapInArrow(run, schema), "assigned")
    tree.destroy()
    scratch.drop("vectors")
    exact = F.col("distance").cast("decimal(38,0)")

    def whole(total: str, missing: str) -> Column:
        return F.when((F.col(missing) == 0) & (F.col(total) <= F.lit(str((1 << 63) - 1)).cast("decimal(38,0)")), F.col(total).cast("long"))

    sums = assigned.groupBy("cluster").agg(F.sum(exact).alias("s"), F.count_if(F.col("distance").isNull()).alias("missing"))
    total = sums.agg(F.sum("s").alias("s"), F.sum("missing").alias("missing")).select(whole("s", "missing")).scalar()
    hashes = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    facts = scratch.spark.createDataFrame(hashes, "cluster int, centroid_sha256 string").join(sums, "cluster")
    facts = facts.select("cluster", whole("s", "missing").alias("cluster_inertia"), total.alias("inertia"), "centroid_sha256")
    out = assigned.join(facts, "cluster")
    return out.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
