import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from celltrace.llm import divergence
from tests.llm.helpers import DOCS, fold, nothing, with_clashes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=30, prior=5, unit=10**9, top=50):
    docs = [(fold(t or ""), la or "", s or "") for _, t, la, s, *_ in rows]
    out = []
    for lang in {la for _, la, _ in docs}:
        mine = [(TERM.findall(t), s) for t, la, s in docs if la == lang]
        seen, times = Counter(), {}
        for found, s in mine:
            seen.update(set(found))
            times.setdefault(s, Counter()).update(found)
        kept = sorted(t for t, n in seen.items() if n >= least)
        whole = sum(times.values(), Counter())

        def share(counts):
            total = sum(counts[t] for t in kept) + prior * len(kept)
            return {t: 1 + unit * (counts[t] + prior) // total for t in kept}

        p, q = {s: share(c) for s, c in times.items()}, share(whole)
        for s in times:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in times if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if times[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def found(frame, **options):
    return sorted(tuple(r) for r in divergence.divergences(frame, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(rnd, n=400):
    words = ["Alpha", "beta", "straße", "日本", "ÄRGER", "naïve", "x", "can't", "e2e", " ", "ß9ß"] + [f"w{chr(97 + i)}" for i in range(40)]
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "en", "en", "de", None, "fr"])
        source = rnd.choice([None, "", "hot", "hot", "hot", "ä", "z", "B", "s1", "s2", "s3", "s4", "s5"])
        body = rnd.choice([" ", ", ", "\n", "-", "1"]).join(rnd.choice(words[: rnd.randint(3, 51)]) for _ in range(rnd.randint(0, 60)))
        rows.append((i, rnd.choice([body] * 9 + [None]), lang, source, 0))
    return rows + rows[:50] + [(9000, "", "only", "a", 0), (9001, None, "only", "b", 0), (9002, "rare words", "one", "a", 0), (9003, "x " * 5000, "en", "long", 0)]


@pytest.mark.parametrize("blocks", [(16, 1024), (2, 3), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", blocks[0])
    monkeypatch.setattr(divergence, "TERM_BLOCK", blocks[1])
    rows = corpus(random.Random(blocks[0]))
    frame = with_clashes(spark.createDataFrame(rows, DOCS), ["part", "id"]).repartition(5)
    assert found(frame) == brute(rows)


def test_few_terms_at_a_time_and_short_slices(spark, monkeypatch):
    rows = corpus(random.Random(3), 60) + [(9100, "y" * 500 + " " + "z" * 70, "en", "long", 0)]
    frame = spark.createDataFrame(rows, DOCS).repartition(3).cache()
    whole = found(frame, least=2, top=4)
    assert whole == brute(rows, least=2, top=4)


def test_terms_of_slices(monkeypatch):
    rnd = random.Random(4)
    for size in (1, 3, 16):
        monkeypatch.setattr(divergence, "_SLICE", size)
        for _ in range(50):
            text = "".join(rnd.choice("aB é-\n9ß ") for _ in range(rnd.randint(0, 80)))
            assert [t.decode() for part in divergence.terms(text.encode()) for t in part] == TERM.findall(fold(text))


def test_batches_end_inside_terms(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = corpus(random.Random(5), 120)
        assert found(spark.createDataFrame(rows, DOCS).repartition(2), least=5) == brute(rows, least=5)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_no_rows_and_no_kept_terms(spark):
    assert found(nothing(spark, DOCS)) == []
    rows = [(1, "a b", "en", "s", 0), (2, "c", "en", "t", 0), (3, None, "en", None, 0)]
    assert found(spark.createDataFrame(rows, DOCS)) == brute(rows)
    assert [r[3:] for r in found(spark.createDataFrame(rows, DOCS))] == [("s", 0, 1), ("t", 0, 2), ("", 0, 1), ("t", 0, 2), ("", 0, 1), ("s", 0, 2)]


def test_counts_beyond_64_bits_when_multiplied(spark):
    frame = spark.range(1).select(F.lit(9 * 10**17 + 1).alias("n"), F.lit(10**18).alias("total"))
    assert frame.select(divergence.share(F.col("n"), F.col("total"), 10**9)).first()[0] == 1 + 10**9 * (9 * 10**17 + 1) // 10**18
