import os
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from celltrace.llm import mixing
from celltrace.llm.queries import tokenizer
from tests.llm.helpers import DOCS, SPLIT, components, edited, random_text, shingle_set, with_clashes
from tests.llm.test_contain import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ROOT = Path(corpus_pipeline.__file__).parent


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with copies, near copies, passages of the benchmark, junk, empty and null texts."""
    rnd = random.Random(8)
    items = [(i, random_text(rnd, rnd.randint(15, 50), 2000)) for i in range(12)]
    rows, good = [], {}

    def add(text, bad=False):
        good[len(rows)] = not bad
        rows.append((len(rows), text, "en", f"s{len(rows) % 5}" if len(rows) % 3 else "s0", len(text or "")))

    for _ in range(150):
        add(random_text(rnd, rnd.randint(30, 200), 2000))
    for base in rows[:12]:
        add(base[1])
        add(edited(rnd, base[1], 1))
        add(base[1].upper())
    for i, text in items:
        add(random_text(rnd, 60, 2000) + " " + text + " " + random_text(rnd, 400, 2000))
    for _ in range(40):
        add(" ".join(w + "###" for w in random_text(rnd, 60, 2000).split()), bad=True)
        add("SPAM!! " * rnd.randint(20, 60), bad=True)
    add(None, bad=True)
    add("", bad=True)
    top = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    labels = [(i, int(g), 0) for i, g in good.items() if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return str(top), rows, items, good


def test_every_stage_against_brute_force(spark, folder):
    top, rows, items, good = folder
    docs = spark.read.parquet(f"{top}/documents.parquet")
    by_id = {r[0]: r for r in rows}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "mixing", "token_files"]
    before = set(by_id)
    for name in list(stages)[:3]:
        found = stages[name](spark, docs, top)
        assert found.columns == COLUMNS
        kept = found.collect()
        assert len(kept) == len({r.doc_id for r in kept}) and all(tuple(r) == by_id[r.doc_id] for r in kept)
        left = {r.doc_id for r in kept}
        if name == "quality":
            expected = {i for i in before if good[i]}
        elif name == "near_duplicates":
            label = components({i: shingle_set(by_id[i][1], 5) for i in before})
            expected = {i for i in before if label[i] == i}
            assert len(expected) < len(before) - 30
        else:
            held = {d for d, *_ in brute([by_id[i] for i in before], items)}
            assert len(held) >= 12
            expected = before - held
        assert left == expected
        before, docs = left, spark.createDataFrame(kept, DOCS)
    mixed = stages["mixing"](spark, docs, top)
    assert mixed.columns == COLUMNS
    report = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    got = {r.doc_id: r for r in mixed.collect()}
    assert set(got) == {i for i, r in report.items() if r.taken}
    assert all(len(SPLIT.findall(r.text)) == report[i].taken and set(SPLIT.findall(r.text)) <= set(SPLIT.findall(by_id[i][1])) for i, r in got.items())
    last = stages["token_files"](spark, mixed, top).orderBy("start").collect()
    assert [r.doc_id for r in last] == sorted(got)
    from tokenizers import Tokenizer

    tool, total = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), 0
    for r in last:
        assert (r.start, r.n_tokens) == (total, len(tool.encode(got[r.doc_id].text, add_special_tokens=False).ids) + 1)
        total += r.n_tokens


def test_run_is_the_stages(spark, folder):
    top = folder[0]
    docs = spark.read.parquet(f"{top}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, top)
    assert sorted(map(tuple, corpus_pipeline.run(spark, top).collect())) == sorted(map(tuple, docs.collect()))


def test_stages_pass_other_columns_and_empty_tables(spark, folder):
    top = folder[0]
    docs = with_clashes(spark.read.parquet(f"{top}/documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), top).collect() == []
        out = stage(spark, docs, top)
        assert out.columns == docs.columns
        names = [c for c in out.columns if c not in COLUMNS]
        assert {tuple(r) for r in out.select(*names).distinct().collect()} == {tuple(f"extra {c}" for c in names)}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), top).collect() == []


def test_rest_works_without_this_folder(tmp_path):
    shutil.copytree(ROOT / "celltrace", tmp_path / "celltrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'barcode_assign' in q and not any(n.startswith('op1') for n in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)


def test_other_import_errors_are_not_hidden(tmp_path):
    shutil.copytree(ROOT / "celltrace", tmp_path / "celltrace", ignore=shutil.ignore_patterns("words.py", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(ROOT / name, tmp_path)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True)
    assert done.returncode != 0
