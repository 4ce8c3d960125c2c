"""Written tables and files in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from celltrace.session import ensure_checkpoint_dir, remember


#: Bytes of one Arrow batch on its way to a worker. Spark counts rows (10,000) up to 64 MB, and a batch lies in the JVM (twice while it
#: grows), in the pipe and in the worker at once, for every core of an executor.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``BATCH_BYTES`` (or one row) for the jobs started inside; a smaller setting of the session stays."""
    before = spark.conf.get(_BATCH)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    if 0 < size <= BATCH_BYTES:
        yield
        return
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


class Scratch:
    """Tables of one run. Steps go on from a written table, which outlives lost executors."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = remember(f"{folder or ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        with bounded_batches(self.spark):
            df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns ``c0``, ``c1``, ... and their names by the old ones, so that a column of a user
    never meets one that an operator adds; ``toDF`` with the old names undoes it."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))
