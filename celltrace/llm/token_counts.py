"""Token counts through a digest cache.

The cache is a Parquet table ``(tokenizer, digest, n_tokens)`` in a shared folder. A text's key is the digest of its
normalised content (null counts as empty; nothing else may be folded, as every character can change the count) together
with the digest of the tokenizer file. Texts are joined to the stored counts by key; of the texts without a count each distinct one
is encoded once, and its count is appended. A second run, or another corpus with the same texts, encodes only what is new.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltrace.llm.encoders import encoder
from celltrace.llm.scratch import Scratch

CACHE = "tokenizer string, digest binary, n_tokens long"
_ROWS = 256


def file_digest(path: str) -> str:
    """Version of a tokenizer: the digest of its file."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts; a folder that is not there yet is an empty cache."""
    try:
        return spark.read.schema(CACHE).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, limit: int = 4096, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` per row of ``docs``, after the counts of all new texts went into ``cache``.

    Null texts count as empty, repeated rows and copies share one count. Two runs that append the same key at once store the same
    count twice, which does no harm.
    """
    spark, version = docs.sparkSession, file_digest(tokenizer)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                _, ends = tool.encode_column(part.column(1))
                counts = pa.array(np.diff(ends).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([version] * part.num_rows), part.column(0).cast(pa.binary()), counts], ["tokenizer", "digest", "n_tokens"])

    def known() -> DataFrame:
        return read_cache(spark, cache).filter(F.col("tokenizer") == version)

    scratch = Scratch(spark)
    # copies go first, so that one row of a text meets the cache however often it occurs
    misses = rows.select("digest", "text").dropDuplicates(["digest"]).join(known().select("digest"), "digest", "left_anti")
    counted = scratch.cut(misses.mapInArrow(run, CACHE), "counted")  # the cache gets whole runs only
    counted.write.mode("append").parquet(cache)
    scratch.drop("counted")
    keyed = rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    found = keyed.join(known().dropDuplicates(["digest"]).select("digest", "n_tokens"), "digest")
    return found.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
