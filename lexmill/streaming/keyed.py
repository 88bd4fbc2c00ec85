"""Keyed state of streams, kept by Spark in RocksDB and looked up key by key."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Groups that keys are dealt to by hash. State of a key is found within its group, so the number is fixed with the checkpoint.
GROUPS = 1024


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB: on an executor's disk, with changes saved under the checkpoint."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class LastHash(StatefulProcessor):
    """Hands each row on with the hash that its key had before the micro-batch, and keeps the hash of the greatest seq in it.

    One group of keys is worked on at a time, frame by frame. Held in memory is one entry for each of its keys
    that come in the micro-batch; looked up in the state are these keys alone.
    """

    def __init__(self, key_type: T.DataType, hash_type: T.DataType):
        self.key = T.StructType([T.StructField("key", key_type), T.StructField("known", T.BooleanType())])
        self.value = T.StructType([T.StructField("hash", hash_type)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", self.key, self.value)

    def _before(self, key) -> tuple | None:
        return self.last.getValue(key) if self.last.containsKey(key) else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before: dict[tuple, tuple | None] = {}
        newest: dict[tuple, tuple] = {}
        for frame in rows:
            keys = [(None if pd.isna(k) else k, True) for k in frame["key"]]
            for k in keys:
                if k not in before:
                    before[k] = self._before(k)
            for k, seq, value in zip(keys, frame["seq"], frame["hash"]):
                if k not in newest or seq > newest[k][0]:
                    newest[k] = (seq, None if pd.isna(value) else value)
            found = [before[k] for k in keys]
            yield frame[["key", "seq", "hash"]].assign(known=[f is not None for f in found], last_hash=[f[0] if f else None for f in found])
        for k, (_, value) in newest.items():
            if before[k] is None or before[k][0] != value:
                self.last.updateValue(k, (value,))

    def close(self) -> None:
        pass


def with_last_hash(items: DataFrame, key: str, seq: str, hash: str) -> DataFrame:
    """key, seq, hash, known (whether the key was met in an earlier micro-batch) and last_hash for each row of a stream."""
    rows = items.select(F.col(key).alias("key"), F.col(seq).alias("seq"), F.col(hash).alias("hash"))
    key_type, hash_type = rows.schema["key"].dataType, rows.schema["hash"].dataType
    out = T.StructType([*rows.schema.fields, T.StructField("known", T.BooleanType()), T.StructField("last_hash", hash_type)])
    group = F.pmod(F.xxhash64("key"), F.lit(GROUPS)).cast("int")
    return rows.withColumn("group", group).groupBy("group").transformWithStateInPandas(LastHash(key_type, hash_type), out, "Append", "None")
