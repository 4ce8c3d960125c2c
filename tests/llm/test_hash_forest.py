import numpy as np
import pytest
from pyspark.sql import functions as F

from celltrace.llm import hash_forest
from tests.llm.helpers import nothing, with_clashes

VECTORS = "vec_id long, embedding array<float>, label int"


def exact(rows, asked, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in asked:
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("rows_per_shard", [300, 8192])
def test_recall(spark, monkeypatch, rows_per_shard):
    monkeypatch.setattr(hash_forest, "SHARD_ROWS", rows_per_shard)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((10, 32))
    x = (centres[rng.integers(0, 10, 2000)] + rng.standard_normal((2000, 32))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = with_clashes(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(4))
    found = answers(hash_forest.search(frame, F.col("id") % 100 == 0))
    truth = exact(rows, range(0, 2000, 100))
    assert set(found) == set(truth)
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) / 10 for q in truth]) >= 0.9
    for q, near in found.items():
        assert near == sorted(near, key=lambda p: (p[1], p[0]))
        for i, d in near:
            assert d == pytest.approx(float(np.sqrt(((x[q].astype(float) - x[i]) ** 2).sum())), abs=1e-12)


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, float(i // 2), 0.0]) for i in range(0, 14)]
    odd = [(100, None, 0), (200, [], 0), (300, [0.0, 0.0, 0.0], 0), (400, [1.0, None, 0.0], 0), (500, [1.0, nan, 0.0], 0), (600, [inf, 1.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 0), (700, [1.0, 2.0], 0), (800, [2.0, 2.0], 1)]
    frame = spark.createDataFrame([(i, v, None) for i, v in good] + odd + [(0, [1.0, 0.0, 0.0], 7)], VECTORS)
    found = answers(hash_forest.search(frame, F.col("id") % 100 == 0))
    truth = exact(good, [0])
    assert found == {0: truth[0], 700: [(800, 1.0)], 800: [(700, 1.0)]}


def test_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(hash_forest, "SHARD_ROWS", 64)
    frame = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(500)] + [(500, [3.0, 1.0, 1.0], 0)], VECTORS)
    found = answers(hash_forest.search(frame, F.col("id") % 100 == 0))
    assert found[0] == [(i, 0.0) for i in range(1, 11)] and found[300] == [(i, 0.0) for i in range(10)]
    assert [i for i, _ in found[500]] == list(range(10))


def test_few_and_no_rows(spark):
    assert hash_forest.search(nothing(spark, VECTORS), F.col("id") % 100 == 0).collect() == []
    two = spark.createDataFrame([(0, [1.0, 1.0], 0), (1, [1.0, 0.5], 0)], VECTORS)
    assert answers(hash_forest.search(two, F.col("id") % 100 == 0)) == {0: [(1, 0.5)]}
    assert hash_forest.search(two.limit(1), F.col("id") == 0).collect() == []


def test_ascent_visits_levels_together():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 8))
    planes = hash_forest.projections(8, 6, 1)
    shard = hash_forest.Shard.build(np.arange(400), x, planes, 6)
    strings = hash_forest.hash_strings(x[:5], shard.mean, planes, 6)
    bits = lambda v: f"{int(v):064b}"
    for i, rows in shard.candidates(strings, 500):
        plain = hash_forest.hash_strings(x, shard.mean, planes, 6)
        for level in range(64, -1, -1):
            hits = [{r for r in range(400) if bits(plain[t, r])[:level] == bits(strings[t, i])[:level]} for t in range(6)]
            if sum(map(len, hits)) >= 500 or level == 0:
                break
        assert set(rows.tolist()) == set().union(*hits)
