"""Keyed tables in hash buckets: a change writes only what changed, a reader sees any kept state whole.

Rows lie under `root`/name/kind=base|delta/epoch=E/bucket=B. Each epoch has a manifest of the folders
that make up its state; what is listed there is never written again, so readers of an older epoch go
on undisturbed while newer ones are written or buckets compacted. A manifest holds at most
(buckets x (deltas + 1)) rows and is all of a table that the driver looks at.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.schemas import empty
from lexmill.session import names_in, read_text, remove, write_text
from lexmill.streaming import epochs

#: Buckets of a table, fixed when it is started: about as many as it will have GB.
BUCKETS = 16
#: Deltas of a bucket beyond which it is compacted.
DELTAS = 8


class Part(NamedTuple):
    """A folder of rows; `high` is the greatest value of the table's counting column in it."""

    kind: str
    epoch: int
    bucket: int
    rows: int
    high: int | None


class Store(NamedTuple):
    """A table under `root`: rows of a key share a bucket.

    The rows of a key written last stand for it, all of them (one for a plain key, several for children of a
    parent); with `append` every row ever written counts. `counter` names a whole-number column whose greatest value is kept at hand.
    """

    root: str
    name: str
    schema: T.StructType
    key: str
    append: bool = False
    counter: str | None = None
    buckets: int = BUCKETS

    @property
    def path(self) -> str:
        return f"{self.root}/{self.name}"

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")


def start(spark: SparkSession, stores: list[Store]) -> None:
    """Makes the pointer that the tables of a root share, where it does not exist yet, and holds each table to its number of buckets."""
    epochs.start(spark, stores[0].root, {})
    for store in stores:
        if "buckets" not in names_in(spark, store.path):
            write_text(spark, f"{store.path}/buckets", str(store.buckets))
        elif int(read_text(spark, f"{store.path}/buckets")) != store.buckets:
            raise ValueError(f"{store.path} was started with another number of buckets")


def _listed(spark: SparkSession, store: Store) -> list[int]:
    """Epochs that have a manifest, in order."""
    return sorted(int(n) for n in names_in(spark, f"{store.path}/manifest") if n.isdigit())


def manifest(spark: SparkSession, store: Store, epoch: int) -> list[Part]:
    """Parts of the state as of an epoch: those of the last manifest up to it."""
    at = max((a for a in _listed(spark, store) if a <= epoch), default=None)
    return [] if at is None else [Part(*p) for p in json.loads(read_text(spark, f"{store.path}/manifest/{at}"))]


def _list(spark: SparkSession, store: Store, epoch: int, parts: list[Part]) -> None:
    write_text(spark, f"{store.path}/manifest/{epoch}", json.dumps(parts))


def highest(parts: list[Part]) -> int:
    return max((p.high for p in parts if p.high is not None), default=0)


def touched(store: Store, keys: DataFrame, key: str | None = None) -> list[int]:
    """Buckets that hold the keys of `keys`."""
    return [r[0] for r in keys.select(store.bucket(F.col(key or store.key))).distinct().collect()]


def _rows(spark: SparkSession, store: Store, parts: list[Part]) -> DataFrame:
    if not parts:
        return empty(spark, T.StructType([*store.schema.fields, T.StructField("epoch", T.LongType())]))
    folders = [f"{store.path}/kind={p.kind}/epoch={p.epoch}/bucket={p.bucket}" for p in parts]
    places = [("kind", T.StringType()), ("epoch", T.LongType()), ("bucket", T.IntegerType())]
    schema = T.StructType([*store.schema.fields, *[T.StructField(n, t) for n, t in places]])
    return spark.read.schema(schema).option("basePath", store.path).parquet(*folders).drop("kind", "bucket")


def _live(spark: SparkSession, store: Store, parts: list[Part]) -> DataFrame:
    """Rows that count. Buckets without deltas are read as they are; in others a base row gives way to any delta of its key."""
    mixed = set() if store.append else {p.bucket for p in parts if p.kind == "delta"}
    plain = _rows(spark, store, [p for p in parts if p.bucket not in mixed]).select(*store.schema.names)
    if not mixed:
        return plain
    base = _rows(spark, store, [p for p in parts if p.bucket in mixed and p.kind == "base"])
    deltas = _rows(spark, store, [p for p in parts if p.bucket in mixed and p.kind == "delta"])
    last = deltas.groupBy(store.key).agg(F.max("epoch").alias("_last"))
    newest = deltas.join(last.withColumnRenamed(store.key, "_key"), F.col(store.key).eqNullSafe(F.col("_key")) & (F.col("epoch") == F.col("_last")), "left_semi")
    kept = base.join(last.select(F.col(store.key).alias("_key")), F.col(store.key).eqNullSafe(F.col("_key")), "left_anti")
    return plain.unionByName(kept.select(*store.schema.names)).unionByName(newest.select(*store.schema.names))


def read(spark: SparkSession, store: Store, epoch: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The table as of an epoch (the last finished one if not given), or some buckets of it."""
    parts = manifest(spark, store, epochs.latest(spark, store.root) if epoch is None else epoch)
    wanted = None if buckets is None else set(buckets)
    return _live(spark, store, [p for p in parts if wanted is None or p.bucket in wanted])


def _write(df: DataFrame, store: Store, kind: str, epoch: int, only: set[int] | None = None) -> list[Part]:
    """Writes rows by bucket; a large bucket is split over several tasks and files.

    Deltas replace all that the epoch wrote before; a base only replaces its own buckets.
    """
    spark, folder = df.sparkSession, f"{store.path}/kind={kind}/epoch={epoch}"
    dealt = df.select(*store.schema.names).withColumn("bucket", store.bucket(F.col(store.key))).hint("rebalance", "bucket")
    how = "static" if kind == "delta" else "dynamic"
    dealt.write.mode("overwrite").option("partitionOverwriteMode", how).partitionBy("bucket").parquet(folder)
    written = spark.read.schema(T.StructType([*store.schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(folder)
    written = written if only is None else written.where(F.col("bucket").isin(*only))
    high = F.max(store.counter).cast("long") if store.counter else F.lit(None).cast("long")
    return [Part(kind, epoch, *r) for r in written.groupBy("bucket").agg(F.count(F.lit(1)), high).collect()]


def write(df: DataFrame, store: Store, epoch: int, deltas: int = DELTAS) -> list[Part]:
    """Adds the changed rows of an epoch and lists its state; buckets with more than `deltas` deltas are compacted.

    Call `epochs.finish` when all tables of an epoch are written: until then readers see the one before. An epoch
    that is written again replaces only its own folders. Returns the parts of the new state.
    """
    spark = df.sparkSession
    parts = manifest(spark, store, epoch - 1) + _write(df, store, "delta", epoch)
    return _compacted(spark, store, epoch, deltas, parts)


def compact(spark: SparkSession, store: Store, epoch: int, deltas: int = 0) -> list[Part]:
    """Merges each bucket that has more than `deltas` deltas into one base folder; other buckets are not read."""
    return _compacted(spark, store, epoch, deltas, manifest(spark, store, epoch))


def _compacted(spark: SparkSession, store: Store, epoch: int, deltas: int, parts: list[Part]) -> list[Part]:
    counts: dict[int, int] = {}
    for p in parts:
        counts[p.bucket] = counts.get(p.bucket, 0) + (p.kind == "delta")
    full = {b for b, n in counts.items() if n > deltas}
    if full:
        old = [p for p in parts if p.bucket in full]
        parts = [p for p in parts if p.bucket not in full] + _write(_live(spark, store, old), store, "base", epoch, full)
    _list(spark, store, epoch, parts)
    return parts


def vacuum(spark: SparkSession, store: Store, keep: int = 2) -> list[str]:
    """Removes folders and manifests that the last `keep` finished epochs do not need; returns what went."""
    last = epochs.latest(spark, store.root)
    oldest = last - keep + 1
    ats = _listed(spark, store)
    base = max((a for a in ats if a <= oldest), default=-1)
    needed = {p[:3] for at in ats if at >= base for p in manifest(spark, store, at)}
    gone = []
    for at in ats:
        if at < base:
            gone += [f"{store.path}/kind={p.kind}/epoch={p.epoch}/bucket={p.bucket}" for p in manifest(spark, store, at) if p[:3] not in needed]
            gone.append(f"{store.path}/manifest/{at}")
    paths = sorted(set(gone))
    for path in paths:
        remove(spark, path)
    return paths
