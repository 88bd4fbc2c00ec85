"""Stored tables: reading, writing, exporting, resetting, and the vector index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lexmill import schemas
from lexmill.functions.text import iso_date, iso_time


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = schemas.TABLES.get(name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{name}")


def read_samples(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """Only the named columns reach the scan."""
    return spark.read.parquet(path).select(*cols)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def init_tables(spark: SparkSession, root: str) -> list[str]:
    """Create the tables that are absent, empty; returns their names."""
    made = []
    for name, schema in schemas.TABLES.items():
        path = f"{root.rstrip('/')}/{name}"
        if not exists(spark, path):
            schemas.empty(spark, schema).write.mode("overwrite").parquet(path)
            made.append(name)
    return made


def reset(spark: SparkSession, root: str) -> None:
    """Empty every table."""
    for name, schema in schemas.TABLES.items():
        schemas.empty(spark, schema).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a derived table. `path` must not be one that `df` reads."""
    df.write.mode("overwrite").parquet(path)


def export_form(norms: DataFrame) -> DataFrame:
    """Norms as published: ISO dates as text, validity as a boolean."""
    out = norms
    for name, kind in norms.dtypes:
        if kind == "date":
            out = out.withColumn(name, iso_date(name))
        elif kind.startswith("timestamp"):
            out = out.withColumn(name, iso_time(name))
    return out.withColumn("is_valid", F.col("is_valid").cast("boolean")) if "is_valid" in norms.columns else out


def export(norms: DataFrame, fmt: str, path: str) -> None:
    """Sharded CSV with header, or JSON lines."""
    writer = export_form(norms).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def export_samples(samples: DataFrame, path: str) -> None:
    cols = ["code_id", "code_name", "article_num", "label", "text"]
    samples.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A report as a table, so that later runs can be compared by query."""
    metrics.write.mode("overwrite").parquet(path)


def write_index(df: DataFrame, path: str, rebuild: bool = False) -> bool:
    """Write vectors with their metadata; an existing index stays unless `rebuild`. Returns whether it wrote."""
    if not rebuild and exists(df.sparkSession, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
