"""From raw documents to token files: quality, near duplicates, benchmark passages, source weights, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All but the last return the columns
of ``documents``; tables beside the documents come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from celltrace.llm import contain, mixing, neardup, quality, tokenfiles
from celltrace.llm.queries import table, tokenizer
from celltrace.llm.scratch import Scratch


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half; texts without words go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates on five-word shingles."""
    return neardup.keep_first(docs, width=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contain.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that a mix of the sources to their target weights takes, one row per document."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and per document its place in them."""
    return tokenfiles.token_table(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", token_files),
]

#: Classifiers, MinHash and tokenizers are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
