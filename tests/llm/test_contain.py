import random

import duckdb
import pytest

from celltrace.llm import contain, queries
from tests.llm.helpers import DOCS, edited, nothing, random_text, shingle_set, with_clashes

ITEMS = "item_id long, text string"


def brute(docs, items, percent=80):
    out = set()
    for item, text in items:
        q = shingle_set(text, 5)
        for doc in docs:
            d = shingle_set(doc[1], 5)
            if q and 100 * len(q & d) >= percent * len(q):
                out.add((doc[0], item, len(q), len(q & d)))
    return out


def data(seed):
    rnd = random.Random(seed)
    items = [(i, random_text(rnd, n, 3000)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 9, 12, 15, 20, 31, 40, 59, 90, 150])]
    docs = []
    for i in range(120):
        words = random_text(rnd, rnd.choice([0, 3, 20, 300, 3000]), 3000).split()
        for _, text in rnd.sample(items, 2):
            piece = edited(rnd, text, rnd.choice([0, 0, 1, 2, len(text.split()) // 8])).split()
            at = rnd.randint(0, len(words))
            if rnd.random() < 0.3:  # in two parts, far apart
                words = words[:at] + piece[: len(piece) // 2] + words[at:] + ["gap"] * 300 + piece[len(piece) // 2 :]
            else:
                words = words[:at] + piece + words[at:]
        docs.append((i, " ".join(words), "en", "s", 0))
    return docs + [(200, None, None, None, None), (201, "", None, None, None), (202, " ".join(t for _, t in items).upper(), None, None, None), (203, items[10][1], None, None, None)], items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = data(seed)
    found = contain.contained_items(with_clashes(spark.createDataFrame(docs, DOCS)), spark.createDataFrame(items, ITEMS)).collect()
    assert {tuple(r)[:4] for r in found} == brute(docs, items) and len(found) > 50
    assert all(r.containment == r.n_shared / r.n_shingles for r in found)


def test_items_of_one_to_four_words(spark):
    items = [(1, "yes"), (2, "Yes no"), (3, "one two three"), (4, "a b c d"), (5, "a b c d e")]
    texts = ["yes", "YES\n", "yes no", "yes it is no use", "no yes", "one two three", "one two three four five six", "a b c d", "a b c d e", "x a b c d e", "a b c"]
    docs = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    frame, table = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = {(r.doc_id, r.item_id) for r in contain.contained_items(frame, table).collect()}
    assert found == {(0, 1), (1, 1), (2, 2), (5, 3), (7, 4), (8, 5), (9, 5)} == {x[:2] for x in brute(docs, items)}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM (VALUES " + ", ".join(f"({i}, $${t}$$)" for i, t, *_ in docs) + ") AS d(doc_id, text)")
    con.execute("CREATE TABLE benchmark AS SELECT * FROM (VALUES " + ", ".join(f"({i}, $${t}$$)" for i, t in items) + ") AS d(item_id, text)")
    assert {r[:2] for r in con.execute(queries.ORACLE["op7_minhash_containment"]).fetchall()} == found
    assert sorted(r.doc_id for r in contain.decontaminate(frame, table).collect()) == [3, 4, 6, 10]


def test_slices_and_decontaminate(spark, monkeypatch):
    monkeypatch.setattr(contain, "SLICE_SHINGLES", 60)
    docs, items = data(3)
    docs = docs + [docs[0]]
    frame = with_clashes(spark.createDataFrame(docs, DOCS))
    expected = brute(docs, items)
    assert {tuple(r)[:4] for r in contain.contained_items(frame, spark.createDataFrame(items, ITEMS)).collect()} == expected
    clean = contain.decontaminate(frame, spark.createDataFrame(items, ITEMS))
    assert clean.columns == frame.columns
    held = {d for d, *_ in expected}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d[0] for d in docs if d[0] not in held)


def test_empty_sides(spark):
    docs, items = data(4)
    full, table = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert contain.contained_items(nothing(spark, DOCS), table).collect() == []
    assert contain.contained_items(full, nothing(spark, ITEMS)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "  ")], ITEMS)
    assert contain.contained_items(full, blank).collect() == [] and contain.decontaminate(full, blank).count() == len(docs)
    repeated = spark.createDataFrame([(1, "p q r s t u"), (1, "p q r s t u"), (None, "p q r s t u")], ITEMS)
    one = spark.createDataFrame([(9, "x p q r s t u y", "", "", 0)], DOCS)
    assert [r.item_id for r in contain.contained_items(one, repeated).collect()] == [1, 1, None]


def test_long_words_and_texts(spark):
    item = "alpha beta gamma delta epsilon zeta"
    rows = [(1, "z" * 3_000_000 + " " + item + " " + "y " * 400_000, "", "", 0), (2, "z " * 500_000, "", "", 0)]
    found = contain.contained_items(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, item)], ITEMS)).collect()
    assert [r.doc_id for r in found] == [1]
