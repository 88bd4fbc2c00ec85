"""Named queries over the driver tables and, where SQL can say it, the same query for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.operators.skew import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are costly to work on, spread over the cores when it comes in few files."""
    return spread(table(spark, sf_dir, name))
