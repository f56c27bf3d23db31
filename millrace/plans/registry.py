"""Registry of queries and of their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """Tables of one data folder by attribute."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register ``f(tables)`` under its name, with the equivalent SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add
