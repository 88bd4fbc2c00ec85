"""Registry of this subpackage's queries and helpers shared by its operators."""

from __future__ import annotations

import string
import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.session import stage

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


def kept_by_worker(key: str, make: Callable[[], Any]) -> Any:
    """What `make` gave when this Python worker first asked for `key`; its later tasks get the same object."""
    kept = sys.modules.setdefault("_lexmill_kept", types.ModuleType("_lexmill_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; other letters stay as they are."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def number_rows(df: DataFrame, by: list[str], out: str = "row_number") -> tuple[DataFrame, int]:
    """Rows with a gapless global number from 0 in the order of `by` (nulls first), and how many there are.

    `df` should hold few, small columns: it is written once under the shared
    folder, sorted by ranges, and written again, so that the number of a row
    (rows in earlier ranges plus its place in its own) is fixed. Rows equal in
    every column of `by` take their numbers in any order; a hash of their place
    spreads a hot group of them over many ranges. One row per range is summed
    in one task; no data row is.
    """
    spark = df.sparkSession
    slim = stage(df.withColumn("_lexmill_tie", F.xxhash64(F.monotonically_increasing_id())), "numbered-in")
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [*[F.col(c).asc_nulls_first() for c in by], F.col("_lexmill_tie")]
    ordered = slim.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("_lexmill_tie")
    placed = stage(
        ordered.withColumn("_lexmill_range", F.spark_partition_id())
        .withColumn("_lexmill_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "numbered",
    )
    sizes = placed.groupBy("_lexmill_range").agg(F.count(F.lit(1)).alias("_lexmill_n"))
    starts = sizes.select("_lexmill_range", (F.sum("_lexmill_n").over(Window.orderBy("_lexmill_range")) - F.col("_lexmill_n")).alias("_lexmill_start"))
    numbered = placed.join(F.broadcast(starts), "_lexmill_range").withColumn(out, F.col("_lexmill_start") + F.col("_lexmill_at"))
    return numbered.drop("_lexmill_range", "_lexmill_at", "_lexmill_start"), placed.count()


def text_key(id: str, text: str) -> Column:
    """Hash of a row's id and whole text, by which a decision finds its rows again."""
    return F.xxhash64(F.col(id), F.coalesce(F.col(text), F.lit("")))


def without(docs: DataFrame, gone: DataFrame, id: str, text: str) -> DataFrame:
    """`docs` without the rows named by `gone` (columns id and text_key); nulls in id equal each other.

    What goes grows with the documents, so it is never broadcast: both sides meet by id and key at any size.
    """
    keyed = docs.withColumn("_lexmill_key", text_key(id, text))
    gone = gone.select(F.col("id").alias("_lexmill_gone_id"), F.col("text_key").alias("_lexmill_gone_key"))
    same = (F.col("_lexmill_key") == F.col("_lexmill_gone_key")) & F.col(id).eqNullSafe(F.col("_lexmill_gone_id"))
    return keyed.join(gone.hint("merge"), same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
