"""Binary files written and read by Spark, so that any store that Spark reaches will do."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one file; a record that is longer gets a file of its own.
FILE_BYTES = 16 << 20


def packed(records: Iterable[bytes], head, limit: int = FILE_BYTES) -> Iterator[bytes]:
    """File contents: `head(number of file)` and then records, up to `limit` bytes of them."""
    number, parts, size = 0, [], 0
    for record in records:
        if parts and size + len(record) > limit:
            yield b"".join(parts)
            number, parts, size = number + 1, [], 0
        if not parts:
            parts = [head(number)]
            size = len(parts[0])
        parts.append(record)
        size += len(record)
    if parts:
        yield b"".join(parts)


def as_batches(contents: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    """One batch for each file, as output of mapInArrow with schema `content binary`."""
    for content in contents:
        yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])


def write_files(contents: DataFrame, path: str) -> None:
    """Each row's `content` as a file of its own, committed by Spark's writer.

    The writer ends each file with a line feed, which readers pass over.
    """
    contents.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content of each file; a task holds one file at a time."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
