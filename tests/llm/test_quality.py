import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from celltrace.llm import quality, queries
from tests.llm.helpers import DOCS, nothing, random_text, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed=5, n=300):
    import random

    rnd = random.Random(seed)
    rows, good = [], {}
    for i in range(n):
        good[i] = rnd.random() < 0.8
        text = random_text(rnd, rnd.randint(20, 120))
        if not good[i]:
            text = "BUY!! NOW!! " * 30 if rnd.random() < 0.5 else " ".join(w + "&&&" for w in text.split())
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    return rows, good


def test_held_out_accuracy_and_kept_rows(spark):
    rows, good = corpus()
    extra = [(900, None, "en", "s0", None), (901, " ", None, None, None), (5, *rows[5][1:]), (None, rows[6][1], None, None, 1)]
    docs = with_clashes(spark.createDataFrame(rows + extra, DOCS), ["host"])
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in good.items() if i % 2] + [(1, 1 - int(good[1]), 0), (None, 1, 0), (3, None, 0)], LABELS)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    held_out = [i for i in good if i % 2 == 0]
    assert np.mean([(i in ids) == good[i] for i in held_out]) > 0.98
    assert 900 not in ids and 901 not in ids and ids.count(5) == 2 * good[5] and (None in ids) == good[6]


def test_posterior_by_hand(spark):
    """Grouped shrinkage equals the same sums done in numpy."""
    rng = np.random.default_rng(3)
    rows = [(i, f"h{i % 5 if i % 7 else 9}" if i % 11 else None, f"p{i % 3}" if i % 13 else None, float(rng.normal(1 if i % 5 else -2, 2))) for i in range(400)]
    model = quality.Model(np.zeros(1), np.ones(1), np.zeros(2), 0.7)
    frame = spark.createDataFrame(rows, "i long, host string, path string, evidence double")
    found = {r.i: r for r in quality.with_posterior(frame, model, "host", "path").collect()}
    own = {i: 1 / (1 + np.exp(-(e + 0.7))) for i, _, _, e in rows}

    def groups(key):
        out = {}
        for r in rows:
            n, s = out.get(key(r), (0, 0.0))
            out[key(r)] = n + 1, s + own[r[0]]
        return out

    def strength(sums, mean):
        noise = sum(mean[k] * (1 - mean[k]) for k in sums)
        spread = sum(n * (s / n - mean[k]) ** 2 for k, (n, s) in sums.items())
        size = sum(n for n, _ in sums.values()) - sum(n * n for n, _ in sums.values()) / sum(n for n, _ in sums.values())
        between = (spread - noise) / size
        return min(1e6, max(1.0, noise / len(sums) / between - 1)) if between > 0 else 1e6

    hosts, paths = groups(lambda r: r[1]), groups(lambda r: (r[1], r[2]))
    world = sum(own.values()) / len(own)
    k = strength(hosts, dict.fromkeys(hosts, world))
    shares = {h: (s + k * world) / (n + k) for h, (n, s) in hosts.items()}
    kp = strength(paths, {p: shares[p[0]] for p in paths})
    for i, h, p, e in rows:
        (n, s), (pn, ps) = hosts[h], paths[h, p]
        host = (s - own[i] + k * world) / (n - 1 + k)
        path = (ps - own[i] + kp * host) / (pn - 1 + kp)
        assert found[i].path_share == pytest.approx(path, rel=1e-9)
        assert found[i].posterior == pytest.approx(1 / (1 + np.exp(-(e + np.log(path / (1 - path))))), rel=1e-9)


def test_without_labels_all_stay(spark):
    rows, _ = corpus(n=20)
    docs = spark.createDataFrame(rows, DOCS)
    assert quality.keep_good(docs, nothing(spark, LABELS)).count() == 20
    assert quality.keep_good(docs, spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 20
    assert quality.keep_good(nothing(spark, DOCS), spark.createDataFrame([(1, 1, 0), (2, 0, 0)], LABELS)).collect() == []


def test_sample_bound_and_features(spark):
    rows, good = corpus()
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in good.items()], LABELS)
    docs = spark.createDataFrame(rows, DOCS)
    first, again = (quality.train(docs, labels, sample_rows=60) for _ in range(2))
    assert np.allclose(first.weights, again.weights)
    x = quality.features(pa.array([None, "", "Ab 1!", "a a a a", "x" * 2_000_000]))
    assert not x[:2].any() and x[3, 12] == 0.75 and np.isfinite(x).all()


def test_one_site_of_one_document(spark):
    model = quality.Model(np.zeros(1), np.ones(1), np.zeros(2), 0.0)
    frame = spark.createDataFrame([(1, "h", "p", 3.0)], "i long, host string, path string, evidence double")
    row = quality.with_posterior(frame, model, "host", "path").first()
    assert 0.5 < row.posterior < 1 and row.host_share is not None
    assert quality.with_posterior(frame.filter(F.lit(False)), model, "host", "path").collect() == []


def test_query_has_one_schema_and_agrees_with_the_stage(spark):
    rows, good = corpus(n=200)
    odd = [(5, rows[6][1], None, None, 1), (None, "", "en", None, 0), (900, None, None, "s0", None)]
    docs = with_clashes(spark.createDataFrame(rows + odd, DOCS)).withColumns({c: F.lit("extra") for c in ("_id", "_y", "_own", "host_share")})
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in good.items() if i % 2], LABELS)
    judged, unknown = queries.judged_documents(docs, labels), queries.judged_documents(docs, nothing(spark, LABELS))
    assert [(f.name, f.dataType) for f in judged.schema] == [(f.name, f.dataType) for f in unknown.schema]
    assert unknown.count() == 203 and unknown.filter("kept AND posterior = 0.5 AND evidence = 0").count() == 203
    kept = sorted((r.doc_id is None, r.doc_id) for r in judged.filter("kept").select("doc_id").collect())
    assert kept == sorted((r.doc_id is None, r.doc_id) for r in quality.keep_good(docs, labels).select("doc_id").collect())
    assert judged.count() == 203 and queries.judged_documents(nothing(spark, DOCS), labels).collect() == []


def test_one_row_per_labelled_id(spark):
    """Many rows of one id, and ids labelled both ways, change nothing but that one row."""
    rows, good = corpus(n=120)
    labels = [(i, int(g), 0) for i, g in good.items()]
    docs = spark.createDataFrame(rows, DOCS)
    plain = quality.train(docs.filter("doc_id <> 7"), spark.createDataFrame(labels, LABELS))
    both = quality.train(docs, spark.createDataFrame(labels + [(7, 1 - int(good[7]), 0), (9, int(good[9]), 1)], LABELS))
    assert np.allclose(plain.weights, both.weights)
    first = quality.train(docs, spark.createDataFrame(labels, LABELS), sample_rows=50)
    many = docs.unionByName(docs.filter("doc_id IN (3, 4, 8)").crossJoin(spark.range(300)).drop("id"))
    again = quality.train(many.repartition(7), spark.createDataFrame(labels, LABELS), sample_rows=50)
    assert np.allclose(first.weights, again.weights)
