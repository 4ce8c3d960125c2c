import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from celltrace.llm import simhash
from celltrace.llm.components import components
from celltrace.llm.scratch import Scratch
from tests.llm.helpers import DOCS, edited, nothing, random_text, with_clashes, word_list


def plain(text, width=3):
    w = word_list(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + width]).encode(), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, distance=3):
    """Smallest linked place per place, comparing all pairs."""
    label = list(range(len(values)))
    x = np.array(values, np.uint64)
    changed = True
    near = [np.flatnonzero(np.bitwise_count(x ^ v) <= distance) for v in x]
    while changed:
        changed = False
        for i, others in enumerate(near):
            low = min(label[j] for j in others)
            if low < label[i]:
                label[i], changed = low, True
    return label


def corpus(rnd):
    base = [random_text(rnd, n) for n in (2, 5, 40, 150, 600)]
    texts = [random_text(rnd, rnd.randint(1, 80)) for _ in range(60)]
    for text in base:
        texts += [text] * 4 + [edited(rnd, text, rnd.randint(1, 3)) for _ in range(30)]
    texts += ["", None, " \n\t", "one", "ONE", "one two", "Ünï Ünï", "a " * 3000, "A\x0b" * 3000, "x" * 700]
    rnd.shuffle(texts)
    return [(5 * i + 2, t, "en", "s", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("bounds", [(8192, 32), (4, 2)])
def test_equals_all_pairs(spark, monkeypatch, bounds):
    monkeypatch.setattr(simhash, "HELD", bounds[0])
    monkeypatch.setattr(simhash, "FEW", bounds[1])
    rows = corpus(random.Random(bounds[0]))
    values = [plain(t) for _, t, *_ in rows]
    label = linked(values)
    found = simhash.near_duplicates(with_clashes(spark.createDataFrame(rows, DOCS), ["id"]).repartition(3)).collect()
    assert {r.doc_id: r.fingerprint for r in found} == {r[0]: f"{v:016x}" for r, v in zip(rows, values)}
    assert {r.doc_id: r.component_id for r in found} == {r[0]: rows[i][0] for r, i in zip(rows, label)}


def test_spark_hash_of_one_shingle(spark):
    text = "three small words"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == simhash.fingerprint(text.encode())


def test_slices_change_nothing(monkeypatch):
    rnd = random.Random(1)
    texts = [random_text(rnd, n) for n in (0, 1, 2, 3, 50, 400)] + ["  \t", "one\x0btwo\x1cthree four  five\r\nsix"]
    for size in (1, 7, 64):
        monkeypatch.setattr(simhash, "_SLICE", size)
        for t in texts:
            assert simhash.fingerprint(t.encode()) == plain(t)


@pytest.mark.parametrize("held", [8, 64, 8192])
def test_dense_groups_lose_no_link(spark, monkeypatch, held):
    """Fingerprints of few free bits share most of their variants."""
    monkeypatch.setattr(simhash, "HELD", held)
    rnd = random.Random(held)
    values = set()
    for centre in (rnd.getrandbits(64) for _ in range(4)):
        free = rnd.sample(range(64), 14)
        for _ in range(90):
            values.add(centre ^ sum(1 << b for b in rnd.sample(free, rnd.randint(0, 7))))
    lone = rnd.getrandbits(32)  # one half equal, the other half far apart
    values |= {lone << 32 | rnd.getrandbits(32) for _ in range(150)}
    values = sorted(values)
    signed = [int(v) - (1 << 64) if v >> 63 else int(v) for v in values]
    scratch = Scratch(spark)
    links = scratch.cut(simhash.links(scratch, spark.createDataFrame([(v,) for v in signed], "fp long")), "links")
    for a, b in links.collect():
        assert (a ^ b).bit_count() <= 3 if a ^ b >= 0 else ((a ^ b) + (1 << 64)).bit_count() <= 3
    named = {r.node: r.component for r in components(scratch, links, "c").collect()}
    label = linked(values)
    groups, wanted = {}, {}
    for v, i in zip(signed, label):
        groups.setdefault(named.get(v, v), set()).add(v)
        wanted.setdefault(i, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_a_forest_is_no_list_of_pairs():
    values = np.array([1 << i for i in range(64)] + [0, (1 << 64) - 1], np.uint64)
    left, right = simhash.forest(values, 3)
    assert len(left) == 64 and (np.bitwise_count(left ^ right) <= 3).all()


def test_null_ids_repeats_and_empty_tables(spark):
    rows = [(None, "a b c d", "", "", 0), (7, "a b c d", "", "", 0), (None, "other words stand here", "", "", 0), (3, None, "", "", 0), (3, "", "", "", 0)]
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert found == sorted([(None, 7), (7, 7), (None, None), (3, 3), (3, 3)], key=str)
    assert simhash.near_duplicates(nothing(spark, DOCS)).collect() == []
    with pytest.raises(ValueError):
        simhash.near_duplicates(nothing(spark, DOCS), distance=4)
