import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from celltrace.llm import neardup
from celltrace.llm.components import components as linked
from celltrace.llm.scratch import Scratch
from tests.llm.helpers import DOCS, components, edited, nothing, random_text, shingle_set, twins, with_clashes


def corpus(rnd):
    base = [random_text(rnd, n) for n in (3, 8, 30, 60, 200)]
    texts = [random_text(rnd, rnd.randint(1, 80)) for _ in range(60)]
    for text in base:
        texts += [text] * 3 + [edited(rnd, text, rnd.randint(1, 8)) for _ in range(25)]
    texts += ["", None, "   ", "one", "ONE", "one two", "x " * 4000, "X " * 4000]
    rnd.shuffle(texts)
    return [(3 * i + 1, t, "en", "s", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_all_pairs(spark, width):
    rows = corpus(random.Random(width))
    expected = components({r[0]: shingle_set(r[1], width) for r in rows})
    found = neardup.near_duplicates(with_clashes(spark.createDataFrame(rows, DOCS), ["id"]), width=width).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {r[0]: len(shingle_set(r[1], width)) for r in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    for name, value in (("BLOCK_SHINGLES", 64), ("BLOCK_MEMBERS", 2), ("SKETCH_ANCHORS", 2), ("SKETCH_STREAM", 4), ("LARGE_BUCKET", 3)):
        monkeypatch.setattr(neardup, name, value)
    rows = corpus(random.Random(9))
    expected = components({r[0]: shingle_set(r[1], 2) for r in rows})
    found = neardup.near_duplicates(spark.createDataFrame(rows, DOCS), width=2).collect()
    assert {r.doc_id: r.component_id for r in found} == expected


def test_chain_through_the_group_edge(spark):
    """a - b - c with a and c too far apart are one group."""
    words = [f"w{i}" for i in range(101)]
    def change(base, places):
        return [f"n{p}" if p in places else w for p, w in enumerate(base)]
    a = words
    b = change(a, range(0, 18, 2))
    c = change(b, range(60, 78, 2))
    rows = [(1, " ".join(c), "", "", 0), (2, " ".join(a), "", "", 0), (3, " ".join(b), "", "", 0)]
    expected = components({r[0]: shingle_set(r[1], 2) for r in rows})
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, DOCS), width=2).collect()} == expected


def test_kept_documents_and_odd_ids(spark):
    rows = [(2, "a b c d e f", "x", None, 1), (1, "a b c d e f", "y", "s", 2), (None, "q r s t u v", "z", "s", 3), (5, None, None, None, None), (6, "", None, None, None),
            (7, "k l m n o p", "a", "s", 4), (7, "k l m n o p", "a", "s", 4)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    out = neardup.keep_first(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.lang) for r in out.collect()) == sorted([(1, "y"), (0, "z"), (5, None), (6, None), (7, "a")])


def test_rows_of_one_id_collapse_by_text_only(spark):
    """Null and repeated ids: clean rows stay, and a row is judged by its own text."""
    rows = [(None, "a b c d e f", "n1", "s", 1), (None, "g h i j k l", "n2", "s", 2), (None, "A B C D E F", "n3", "s", 3), (None, None, "n4", "s", 4), (None, "", "n5", "s", 5)]
    rows += [(3, "m n o p q r", "kept", "s", 6)]
    rows += [(5 + i, t, kind, "s", 7) for i in range(20) for t, kind in ((f"u{i} v{i} w{i} x{i} y{i} z{i}", "own"), ("m n o p q r", "copy"))]
    rows += [(40, "k1 k2 k3 k4 k5 k6", "same", "s", 8)] * 2 + [(None, "k1 k2 k3 k4 k5 k6", "later", "s", 8)]
    out = neardup.keep_first(with_clashes(spark.createDataFrame(rows, DOCS))).collect()
    langs = sorted(r.lang for r in out)
    assert [x for x in langs if x in ("n1", "n3")] in (["n1"], ["n3"])
    assert [x for x in langs if x not in ("n1", "n3")] == sorted(["n2", "n4", "n5", "kept", "same"] + ["own"] * 20)


def test_texts_of_a_repeated_id_meet_only_their_class(spark, monkeypatch):
    seen, plain = [], neardup.shingle_sets
    monkeypatch.setattr(neardup, "shingle_sets", lambda texts, width: seen.append(texts.count()) or plain(texts, width))
    rows = [(kind, f"w{i} a{i} b{i} c{i} d{i} e{i} f{i} g{i} h{i} i{i} j{i}{end}", "", "", 0) for i in range(20) for end in ("", " k") for kind in (7, None)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, DOCS), width=2).collect()
    assert len(found) == 80 and {r.component_id for r in found} == {7}
    assert seen[0] <= len(rows)


def test_empty_table(spark):
    assert neardup.near_duplicates(nothing(spark, DOCS)).collect() == []
    assert neardup.keep_first(nothing(spark, DOCS)).collect() == []


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 63, 900, dtype=np.uint64)
    b = np.concatenate([a[:600], rnd.integers(0, 1 << 63, 300, dtype=np.uint64)])
    same = (neardup.circulant_signature(a, 1024) == neardup.circulant_signature(b, 1024)).mean()
    assert abs(same - 600 / 1200) < 0.06
    assert 70 < neardup.least_agreement(128, 80) < 85


def test_components_of_long_chains(spark):
    n = 200
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1002), (1002, 1000)], "a long, b long")
    found = {r.node: r.component for r in linked(Scratch(spark), links, "chain").collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert linked(Scratch(spark), nothing(spark, "a long, b long"), "none").collect() == []


def test_words_with_one_polynomial_value_are_different(spark):
    rows = [(i, f"{w} here", "en", "s", 0) for i, w in enumerate([*twins(10), *twins(11), twins(10)[0]])]
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, DOCS), width=2).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}


def test_a_hot_bucket_of_unlinked_classes_stays_in_proportion(spark, monkeypatch):
    """Classes with one band in common and nothing else: the rows compared grow with their number, not with its square."""
    rnd, counts = random.Random(5), {}
    made = neardup.candidates

    def counted(rows, agreement):
        counts[len(counts)] = rows.count()
        return made(rows, agreement)

    monkeypatch.setattr(neardup, "candidates", counted)
    monkeypatch.setattr(neardup, "LARGE_BUCKET", 64)
    source = neardup.signatures  # everybody's first bucket is 77
    monkeypatch.setattr(neardup, "signatures", lambda *args: source(*args).withColumn("bands", F.when(F.col("n_shingles") > 0, F.concat(F.array(F.lit(77).cast("long")), F.slice("bands", 2, 31)))))
    for n in (300, 1200):
        texts = [random_text(rnd, 40, 100_000) for _ in range(n)]
        rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts + [edited(rnd, texts[0], 1), edited(rnd, texts[7], 1)])]
        found = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, DOCS), width=2).collect()}
        assert found == components({r[0]: shingle_set(r[1], 2) for r in rows}) if n == 300 else found[n] == 0 and found[n + 1] == 7
    assert counts[1] < 100 and counts[0] < 100


def test_links_of_a_large_bucket_that_share_nothing_else(spark, monkeypatch):
    """Linked classes whose only common band is that of a large bucket are found."""
    monkeypatch.setattr(neardup, "LARGE_BUCKET", 64)
    source = neardup.signatures  # everybody's first bucket is 77, all others are one's own
    own = F.transform(F.slice("bands", 2, 31), lambda b, i: F.xxhash64("set_key", i))
    monkeypatch.setattr(neardup, "signatures", lambda *args: source(*args).withColumn("bands", F.when(F.col("n_shingles") > 0, F.concat(F.array(F.lit(77).cast("long")), own))))
    rnd = random.Random(6)
    texts = [random_text(rnd, 40, 100_000) for _ in range(200)]
    texts += [edited(rnd, t, 1) for t in texts[:12]] + [t + " more" for t in texts[20:30]]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, DOCS), width=2).collect()}
    assert found == components({r[0]: shingle_set(r[1], 2) for r in rows})
    assert len(set(found.values())) == 200


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_sets_at_the_threshold_share_a_rare_shingle(spark, percent):
    rnd = random.Random(percent)
    sets = [rnd.sample(range(60), rnd.randint(1, 12)) for _ in range(150)]
    sets += [s + [100 + i] for i, s in enumerate(sets[:50])] + [s[1:] for s in sets[50:90] if len(s) > 1]
    table = spark.createDataFrame([(i, bytearray(np.array(s, np.uint64).tobytes())) for i, s in enumerate(sets)], "cid long, items binary")
    rare = {}
    for r in neardup.rare_shingles(table, percent).collect():
        rare.setdefault(r.cid, set()).add(r.shingle)
    for a, x in enumerate(map(set, sets)):
        for b, y in enumerate(map(set, sets[:a])):
            if 100 * len(x & y) >= percent * len(x | y):
                assert rare[a] & rare[b]
