import random

import numpy as np
import pytest

from celltrace.llm import mixing
from celltrace.llm.scratch import Scratch
from tests.llm.helpers import DOCS, SPLIT, nothing, random_text, with_clashes


def rows(seed=1):
    rnd = random.Random(seed)
    out = [(i, random_text(rnd, rnd.randint(0, 300)), "en", rnd.choice(["b", "a", "a", "a", "Z", "é", None]), 0) for i in range(200)]
    out += [(500, None, None, "a", None), (501, "", None, None, None), (3, *out[3][1:]), (3, *out[3][1:]), (None, "null id " * 50, "", "b", 0), (502, "long " * 20_000, "", "b", 0)]
    return out


def fill_by_rounds(sizes, weights, share=1.5, limit=2.0):
    """The contract's own words: cap what is above, reshare the excess by weight, until none is above."""
    total, fixed = share * sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left, weight = total - sum(fixed.values()), sum(weights[i] for i in free)
        targets = {i: left * weights[i] / weight for i in free}
        above = [i for i in free if targets[i] > limit * sizes[i]]
        if not above:
            return [fixed.get(i, targets.get(i)) for i in range(len(sizes))]
        fixed |= {i: limit * sizes[i] for i in above}


@pytest.mark.parametrize("seed", range(5))
def test_targets(seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 1, 10, 500, 90_000]) for _ in range(rnd.randint(1, 30))]
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    assert mixing.water_fill(sizes, weights, 1.5, 2.0) == pytest.approx(fill_by_rounds(sizes, weights) if sum(sizes) else [0.0] * len(sizes))


def test_permutations():
    for n in (1, 2, 3, 5, 16, 17, 1000):
        for key in (0, 7):
            assert sorted(mixing.permute(np.arange(n), np.full(n, n), np.full(n, key))) == list(range(n))
    assert (mixing.permute(np.arange(500), np.full(500, 500), np.full(500, 1)) != mixing.permute(np.arange(500), np.full(500, 500), np.full(500, 2))).mean() > 0.9


def test_report_follows_the_contract(spark):
    data = rows()
    docs = with_clashes(spark.createDataFrame(data, DOCS))
    found = mixing.mix_report(docs, block_words=16, shard_blocks=64)
    first = sorted((tuple(r) for r in found.collect()), key=str)
    assert first == sorted((tuple(r) for r in mixing.mix_report(docs.repartition(3), block_words=16, shard_blocks=64).collect()), key=str)
    count = lambda t: len(SPLIT.findall(t or ""))
    assert sorted((r[0] or -1, r[1]) for r in first) == sorted((d[0] or -1 if d[0] != 0 else 0, count(d[1])) for d in data) or len(first) == len(data)
    order = sorted({d[3] for d in data if d[3] is not None}) + [None]
    sizes = [sum(count(d[1]) for d in data if d[3] == s) for s in order]
    targets = fill_by_rounds(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(order))])
    by_size = dict(zip(sizes, targets))
    taken = dict.fromkeys(sizes, 0)
    for _, size, source_size, target, got in first:
        assert target == pytest.approx(by_size[source_size]) and 0 <= got <= 2 * size
        taken[source_size] += got
    for size, target in by_size.items():
        assert abs(taken[size] - target) <= 16


def test_mixed_texts_hold_the_taken_words(spark):
    data = [(i, t, *rest) for i, (_, t, *rest) in enumerate(rows(4))]
    docs = with_clashes(spark.createDataFrame(data, DOCS))
    report = {r.doc_id: r.taken for r in mixing.mix_report(docs, block_words=32).collect()}
    mixed = mixing.mix(docs, block_words=32)
    assert mixed.columns == docs.columns
    got = {r.doc_id: r for r in mixed.collect()}
    assert set(got) == {i for i, t in report.items() if t}
    for i, r in got.items():
        words, source = SPLIT.findall(r.text), SPLIT.findall(data[i][1])
        assert len(words) == report[i] and set(words) <= set(source) and r.n_chars == len(r.text)


def test_taken_text():
    text = "  a b\tc  d e "
    assert mixing.taken_text(text, 5, [(0, 2, 1), (2, 4, 1), (4, 5, 1)]) == text
    assert mixing.taken_text(text, 5, [(2, 4, 2), (0, 2, 1)]) == "a b\tc  d\nc  d"


def test_settled_draws(spark):
    plan = mixing.Mixture(["a", "b"], [1000, 50], [1500.0, 75.0], [100, 5], [150, 8])
    found = mixing.slots(Scratch(spark), plan, 3, 16).collect()
    assert [sum(r.place == p for r in found) for p in (0, 1)] == [150, 8]
    assert len({(r.place, r.block, r.pass_no) for r in found}) == 158 and max(r.block for r in found if r.place == 1) < 5
    assert len({r.shard for r in found}) >= 10


def test_nothing_to_mix(spark):
    assert mixing.mix_report(nothing(spark, DOCS)).collect() == [] and mixing.mix(nothing(spark, DOCS)).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, None), (2, " ", "", "s", 1)], DOCS)
    assert sorted(tuple(r) for r in mixing.mix_report(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mix(blank).collect() == []
