import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from celltrace.llm import centroids
from tests.llm.helpers import nothing, with_clashes

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, dim, k=8, rounds=10, scale=1024, seed=3):
    kept = [
        (i, [math.floor(Fraction(x) * scale) for x in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [q for _, q in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centres)) for _, q in kept]

    for _ in range(rounds):
        near = assign()
        for n in range(len(centres)):
            mine = [q for (_, q), (_, m) in zip(kept, near) if m == n]
            if mine:
                centres[n] = [sum(column) // len(mine) for column in zip(*mine)]
    near = assign()
    sums = {n: sum(d for d, m in near if m == n) for n in range(len(centres))}
    fit = lambda x: x if x < 1 << 63 else None
    return sorted(
        ((i, n, fit(d), fit(sums[n]) if fit(max(e for e, m in near if m == n)) is not None else None, hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, near)),
        key=str,
    ), sum(d for d, _ in near)


def found(frame, **options):
    rows = centroids.cluster_vectors(frame, **options).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.centroid_sha256) for r in rows), key=str), {r.inertia for r in rows}


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((6, 64))[rng.integers(0, 6, 400)] + 0.4 * rng.standard_normal((400, 64))).astype(np.float32)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    frame = with_clashes(spark.createDataFrame([(*r, 0) for r in rows], VECTORS), ["id"]).repartition(5)
    expected, total = brute(rows, 64)
    assert found(frame) == (expected, {total})


def test_odd_rows_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    grid = [(i, [float(i % 3), float(i // 3 % 3), -0.5]) for i in range(27)] + [(5, [2.0, 1.0, -0.5])] * 3 + [(None, [1.0, 1.0, 0.0]), (None, [0.0, 0.0, 0.0])]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0]), (103, [1.0, nan, 0.0]), (104, [1.0, -inf, 0.0]), (105, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in grid + odd], VECTORS).repartition(3)
    for k in (1, 3, 8, 40):
        expected, total = brute(grid + odd, 3, k=k)
        assert found(frame, dim=3, k=k) == (expected, {total})


def test_sizes_beyond_64_bits_stay_exact(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([1.0, -3.5, 1e18, -2e30, 3e300]) * rnd.random() for _ in range(4)]) for i in range(60)] + [(99, [1.7e308, -1.7e308, 5e-324, 0.0])]
    expected, _ = brute(rows, 4, k=5)
    rows_found, total = found(spark.createDataFrame([(*r, 0) for r in rows], VECTORS), dim=4, k=5)
    assert rows_found == expected and total == {None}


def test_few_and_no_rows(spark):
    assert centroids.cluster_vectors(nothing(spark, VECTORS)).collect() == []
    two = [(1, [0.25, 0.5]), (2, [0.25, 0.75])]
    expected, total = brute(two, 2)
    assert found(spark.createDataFrame([(*r, 0) for r in two], VECTORS), dim=2) == (expected, {total})
    with pytest.raises(ValueError):
        centroids.cluster_vectors(nothing(spark, VECTORS), k=1 << 20)


@pytest.mark.parametrize("leaf", [1, 2, 5])
@pytest.mark.parametrize("exact", [np.int64, object])
def test_search_equals_all_distances(leaf, exact):
    rng = np.random.default_rng(leaf)
    for k, spread in ((1, 4), (7, 2), (60, 3), (60, 1000), (300, 5)):
        centres = rng.integers(-spread, spread, (k, 3)).astype(exact)
        rows = rng.integers(-spread, spread, (200, 3)).astype(exact)
        best, least, _ = centroids.Tree(centres, leaf).search(rows)
        every = ((rows[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).astype(np.int64)
        assert best.tolist() == every.argmin(axis=1).tolist() and least.tolist() == every.min(axis=1).tolist()


def test_search_prunes():
    rng = np.random.default_rng(8)
    centres = rng.integers(-10_000, 10_000, (500, 2))
    rows = rng.integers(-10_000, 10_000, (1000, 2))
    assert centroids.Tree(centres).search(rows)[2] < 1000 * 500 / 8
