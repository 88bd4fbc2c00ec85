"""Tables that grow by one folder per micro-batch, and a pointer to the last finished one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.schemas import empty
from lexmill.session import remove

EPOCH = "epoch"
_DONE = "_finished"


def start(spark: SparkSession, root: str, schemas: dict[str, T.StructType]) -> None:
    """Makes the tables, empty, where they do not exist yet."""
    for name, schema in (schemas | {_DONE: T.StructType([])}).items():
        frame = empty(spark, schema) if len(schema) else spark.range(0).select(F.col("id").alias("at"))
        frame.write.mode("ignore").parquet(f"{root}/{name}/{EPOCH}=-1")


def write(df: DataFrame, root: str, name: str, epoch: int) -> None:
    """One micro-batch of a table. A batch that is run again replaces its own folder only."""
    df.write.mode("overwrite").parquet(f"{root}/{name}/{EPOCH}={epoch}")


def finish(spark: SparkSession, root: str, epoch: int) -> None:
    """Points readers to `epoch`; called when all its tables are written."""
    write(spark.range(1).select(F.col("id").alias("at")), root, _DONE, epoch)


def latest(spark: SparkSession, root: str) -> int:
    """The last finished epoch, -1 before the first."""
    done = spark.read.schema(f"at long, {EPOCH} long").parquet(f"{root}/{_DONE}")
    return done.agg(F.max(EPOCH)).first()[0] if not done.isEmpty() else -1


def history(spark: SparkSession, root: str, name: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """All rows up to an epoch (the last finished one if not given), with their epoch."""
    upto = latest(spark, root) if upto is None else upto
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])).parquet(f"{root}/{name}")
    return rows.where(F.col(EPOCH) <= upto)


def replace(df: DataFrame, root: str, name: str, epoch: int, kept: int = 2) -> None:
    """A table whose whole state is one epoch: writes it, points to it and removes the one `kept` epochs back."""
    spark = df.sparkSession
    write(df, root, name, epoch)
    finish(spark, root, epoch)
    if epoch >= kept:
        remove(spark, f"{root}/{name}/{EPOCH}={epoch - kept}")


def state(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The table written by `replace`, as of the last finished epoch."""
    last = latest(spark, root)
    return history(spark, root, name, schema, last).where(F.col(EPOCH) == last).drop(EPOCH)
