"""Annotated cells that grow by columns.

A dataset is a folder of column groups, each a table by ``(sample, cell)`` in one folder per sample, and of numbered versions. A
version is one small JSON file that names the groups and their live columns; it appears by a rename that fails if the number is
taken. So a step adds its columns without rewriting the cells or the matrix, a failed step leaves the last version as it
was, two writers at once both get in, and a reader stays with the version that it opened.

A new group replaces columns of the same name in older groups, as a step that is run again replaces its own results.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import PySparkValueError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.schema import CELL

_VERSIONS = "versions"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the committed versions, ascending; none for a folder that is no dataset yet."""
    files, place = _file_system(spark, folder), _path(spark, f"{folder}/{_VERSIONS}")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("_"))


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict:
    """``{"version", "groups": [{"name", "path", "columns", "schema"}]}`` of a version, the last one by default."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise PySparkValueError(f"no version {version or ''} of annotated cells in {folder}")
    line = spark.read.text(f"{folder}/{_VERSIONS}/{version or known[-1]:08d}.json", wholetext=True).first()
    return json.loads(line.value)


def _commit(spark: SparkSession, folder: str, content: dict) -> bool:
    """Whether the version could be taken: its file is written beside and renamed without overwriting."""
    files, jvm = _file_system(spark, folder), spark._jvm
    draft = _path(spark, f"{folder}/{_VERSIONS}/_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(_path(spark, f"{folder}/{_VERSIONS}/{content['version']:08d}.json")), options)
        return True
    except Exception:
        files.delete(draft, False)
        if content["version"] in versions(spark, folder):
            return False  # another writer was first
        raise


def _write_group(table: DataFrame, folder: str, name: str) -> dict:
    """The written columns as an entry of a manifest. Rows without a full key are left out; a repeated key ends the write, as a
    join by it would multiply cells."""
    columns = [c for c in table.columns if c not in CELL]
    keyed = table.dropna(subset=CELL).groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*columns)).alias("_row"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated cell "), F.concat_ws(" ", *CELL)))).otherwise(F.col("_row"))
    rows = keyed.select(*CELL, checked.alias("_row")).select(*CELL, "_row.*").select(*table.columns)
    path = f"{name}-{uuid.uuid4().hex}"
    rows.write.partitionBy("sample").parquet(f"{folder}/{path}")
    return {"name": name, "path": path, "columns": columns, "schema": rows.schema.json()}


def create_cells(cells: DataFrame, folder: str, name: str = "cells") -> int:
    """Start a dataset with the cells of ``cells``, unique by ``(sample, cell)``, and their columns; returns the version, 1."""
    spark = cells.sparkSession
    if versions(spark, folder):
        raise PySparkValueError(f"{folder} holds annotated cells already")
    content = {"version": 1, "groups": [_write_group(cells, folder, name)]}
    if not _commit(spark, folder, content):
        raise PySparkValueError(f"{folder} holds annotated cells already")
    return 1


def append_columns(table: DataFrame, folder: str, name: str) -> int:
    """Add the columns of ``table`` (unique by ``(sample, cell)``) as a new version; returns its number.

    Cells of the dataset that ``table`` lacks get nulls, cells that only ``table`` has are not read. Where another writer took
    the number, the same written group goes on top of that writer's version.
    """
    spark = table.sparkSession
    if not set(table.columns) - set(CELL):
        raise PySparkValueError("no columns beside the key")
    manifest(spark, folder)  # a folder without cells is refused before anything is written
    group = _write_group(table, folder, name)
    while True:
        last = manifest(spark, folder)
        first, *others = [{**g, "columns": [c for c in g["columns"] if c not in group["columns"]]} for g in last["groups"]]
        content = {"version": last["version"] + 1, "groups": [first, *[g for g in others if g["columns"]], group]}
        if _commit(spark, folder, content):
            return content["version"]


def read_cells(spark: SparkSession, folder: str, columns: list[str] | None = None, samples: list[str] | None = None, version: int | None = None) -> DataFrame:
    """All cells with the live columns of a version. Only groups that hold one of ``columns`` are read, and of every group
    only the folders of ``samples``."""
    groups = manifest(spark, folder, version)["groups"]
    live = [c for g in groups for c in g["columns"]]
    if missing := [c for c in columns or [] if c not in [*live, *CELL]]:
        raise PySparkValueError(f"no columns {missing} in {folder}")
    wanted = live if columns is None else [c for c in columns if c not in CELL]

    def table(group: dict) -> DataFrame:
        rows = spark.read.schema(T.StructType.fromJson(json.loads(group["schema"]))).parquet(f"{folder}/{group['path']}")
        rows = rows if samples is None else rows.filter(F.col("sample").isin(samples))
        return rows.select(*CELL, *[c for c in group["columns"] if c in wanted])

    out = table(groups[0])
    for group in groups[1:]:
        if set(group["columns"]) & set(wanted):
            out = out.join(table(group), CELL, "left")
    return out.select(*CELL, *wanted)


def drop_unused(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Delete versions before the last ``keep`` and the group folders that no version left names, also those of failed
    writes; returns the deleted folders. For times without writers and readers of older versions."""
    files, known = _file_system(spark, folder), versions(spark, folder)
    named = {g["path"] for v in known[-keep:] for g in manifest(spark, folder, v)["groups"]}
    for v in known[:-keep]:
        files.delete(_path(spark, f"{folder}/{_VERSIONS}/{v:08d}.json"), False)
    found = [status.getPath().getName() for status in files.listStatus(_path(spark, folder)) if status.isDirectory()]
    gone = sorted(name for name in found if name != _VERSIONS and name not in named)
    for name in gone:
        files.delete(_path(spark, f"{folder}/{name}"), True)
    return gone
