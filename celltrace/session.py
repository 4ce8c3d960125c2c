"""Session settings and lineage cuts."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE picks join sides by measured size and splits skewed partitions, so the
# library gives no unconditional broadcast hints.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "celltrace", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, taken from ``spark.checkpoint.dir``.

    A temporary folder is used only by a local master; a cluster without a
    shared folder is refused because executors could not read each other's files.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="celltrace-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


_WRITTEN: list[str] = []
_NAMES: list[str] = []
_OPEN = threading.local()


def remember(folder: str) -> str:
    """Note a folder of written tables for ``drop_cuts``."""
    _WRITTEN.append(folder)
    for scope in _OPEN.__dict__.get("scopes", [])[-1:]:
        scope.append(folder)
    return folder


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_cuts(spark: SparkSession) -> None:
    """Delete all tables that this program has written on its way: to be called once the results have been stored."""
    while _NAMES:
        spark.sql(f"DROP TABLE IF EXISTS {_NAMES.pop()}")
    while _WRITTEN:
        _delete(spark, _WRITTEN.pop())


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are cut inside the block are deleted at its end, but for those that are cut by the function it gives.

    The collection afterwards lets Spark's cleaner delete the shuffle files of the steps that are over; the driver's own may come much later.
    After an error the tables stay for ``drop_cuts``.
    """
    scopes = _OPEN.__dict__.setdefault("scopes", [])
    scopes.append([])
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        table = cut(df)
        kept.append(scopes[-1].pop())
        return table

    try:
        yield keep
    except BaseException:
        scopes.pop()
        raise
    for folder in scopes.pop():
        _delete(spark, folder)
        _WRITTEN.remove(folder)
    for scope in scopes[-1:]:
        scope.extend(kept)
    gc.collect()
    spark._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and go on from that table.

    Later steps read only the columns they need, survive lost executors, and plan
    with the table's true size. Unlike ``checkpoint()``, a written table carries no
    inferred constraints into the next round of a loop, where they would pile up.
    """
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(remember(folder))
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """Write ``df`` as a table bucketed by ``column`` and go on from that table: joins on the column do not shuffle it any more.

    The table lies in the shared checkpoint folder; its name in the session's catalog goes with ``drop_cuts``.
    """
    spark, name = df.sparkSession, f"celltrace_{uuid.uuid4().hex}"
    folder = remember(f"{ensure_checkpoint_dir(spark)}/{name}")
    df.write.format("parquet").bucketBy(shuffle_width(spark), column).sortBy(column).option("path", folder).saveAsTable(name)
    _NAMES.append(name)
    return spark.table(name)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions for steps whose cost is computing, not bytes: adaptive execution sizes partitions by
    bytes and would put a small but heavy table into one task."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
