"""Session set-up and the shared folder used for staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def build_session(app: str = "lexmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; a cluster keeps its own sizing."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    Only where none is named and all runs in one local process is a temporary
    folder made and set; on a cluster staging then stops with an error, as
    executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    """A path and its file system, as Spark reaches it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, wherever Spark can reach it."""
    target, files = _at(spark, path)
    files.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none where there is no folder."""
    target, files = _at(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's own, put in place whole."""
    (part, files), (target, _) = _at(spark, f"{path}.{uuid.uuid4().hex}"), _at(spark, path)
    out = files.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(target):
        files.delete(target, False)
    files.rename(part, target)


def read_text(spark: SparkSession, path: str) -> str:
    target, files = _at(spark, path)
    source = files.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


#: Rows of megabytes: the writer looks at its memory after every row, and not after each hundred, and holds less of them.
LARGE_ROWS = {"parquet.block.size": 32 << 20, **{f"parquet.{part}.size.row.check.{end}": n for part in ("page", "block") for end, n in (("min", 1), ("max", 4))}}


def release(spark: SparkSession) -> None:
    """Shuffle files of a finished plan stay on the executors' disks until the driver's JVM collects its garbage, which it may put off for half an hour; this asks for it."""
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, name: str = "stage", schema: StructType | None = None, large_rows: bool = False) -> DataFrame:
    """Write `df` once under the shared folder and read it back, with short lineage.

    Used where one result feeds several branches; the files outlive lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    release(spark)
    return spark.read.schema(schema or df.schema).parquet(path)
