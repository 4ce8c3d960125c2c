"""Named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltrace.plans.proxies import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded value without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def quick_rounded(c: Column | str, digits: int = 4) -> Column:
    """Rounding by plain double arithmetic, for tables of many millions of values."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 10.0**digits + 0.5) / F.lit(10.0**digits)
