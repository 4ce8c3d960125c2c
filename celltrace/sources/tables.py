"""Annotated tables, reports and run parameters."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, by_sample: bool = True) -> None:
    """Columnar table, one folder per sample so that a sample filter prunes files."""
    writer = df.write.mode("errorifexists")
    if by_sample and "sample" in df.columns:
        writer = writer.partitionBy("sample")
    writer.parquet(path)


def write_report(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited result table with a header in every part file."""
    df.write.mode("errorifexists").csv(path, header=True, sep=sep)


def write_parameters(spark: SparkSession, parameters: dict, path: str) -> None:
    """Run settings as one JSON line."""
    text = json.dumps(parameters, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)
