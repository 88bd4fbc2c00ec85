"""Continuous ingest, deduplication, change detection and monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexmill import schemas
from lexmill.operators.extract import extract_articles, extract_citations
from lexmill.operators.ingest import merge_versions
from lexmill.operators.skew import lag_sliced, order_slices
from lexmill.session import stage
from lexmill.sources import store
from lexmill.streaming import epochs, keyed

STREAM_TABLES = ("norms", "norm_versions", "norm_articles", "norm_citations")


def read_files(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """Landed Parquet files (a folder or one file) as a stream under a fixed schema."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    path = path.rstrip("/")
    # The source takes a plain path for a folder; only a pattern may also stand for a file.
    return reader.parquet(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")


def stores(root: str, buckets: int = store.BUCKETS) -> dict[str, store.Store]:
    """The tables of the ingest stream: norms by url, versions and children by norm."""
    return {
        "norms": store.Store(root, "norms", schemas.NORMS, "url", counter="id", buckets=buckets),
        "norm_versions": store.Store(root, "norm_versions", schemas.VERSIONS, "norm_id", append=True, counter="id", buckets=buckets),
        "norm_articles": store.Store(root, "norm_articles", schemas.ARTICLES, "norm_id", buckets=buckets),
        "norm_citations": store.Store(root, "norm_citations", schemas.CITATIONS, "norm_id", buckets=buckets),
    }


def snapshot(spark: SparkSession, root: str, name: str, epoch: int | None = None) -> DataFrame:
    """Table state after a micro-batch, by default the last finished one; empty before the first.

    The newest row of a norm counts, every version, and the children of a norm from its newest epoch that has any.
    """
    return store.read(spark, stores(root)[name], epoch)


def merge_into(spark: SparkSession, root: str, batch: DataFrame, epoch: int, now: Column, max_articles: int | None = None,
               max_citations: int | None = None, limits: dict[str, int] | None = None, deltas: int = store.DELTAS,
               buckets: int = store.BUCKETS) -> DataFrame:
    """Merges a batch of items (url, seq, metadata, raw_text) into the stored tables of `stores` as `epoch`; returns its outcomes.

    Only the buckets of norms that the batch touches are read, the greatest ids come from the manifests, and what
    is written are the norms it changed, the versions it added and the children of changed norms. A bucket with more than
    `deltas` deltas is compacted on the way. Readers see the epoch when all four tables are written.
    """
    tables = stores(root, buckets)
    parts = {name: store.manifest(spark, tables[name], epoch - 1) for name in ("norms", "norm_versions")}
    norms = store.read(spark, tables["norms"], epoch - 1, store.touched(tables["norms"], batch))
    highest = tuple(store.highest(parts[name]) for name in ("norms", "norm_versions"))
    merged = merge_versions(norms, schemas.empty(spark, schemas.VERSIONS), batch, now, limits=limits, highest=highest)
    store.write(merged.changed_norms, tables["norms"], epoch, deltas)
    store.write(merged.new_versions, tables["norm_versions"], epoch, deltas)
    touched = merged.outcomes.where(F.col("outcome") != "unchanged")
    changed = stage(touched.groupBy("norm_id").agg(F.max_by("raw_text", "seq").alias("raw_text")), "changed")
    for name, rows in (
        ("norm_articles", extract_articles(changed, "norm_id", "raw_text", max_articles)),
        ("norm_citations", extract_citations(changed, "norm_id", "raw_text", max_citations)),
    ):
        store.write(schemas.conform(rows, schemas.TABLES[name]), tables[name], epoch, deltas)
    epochs.finish(spark, root, epoch)
    return merged.outcomes


def ingest_stream(items: DataFrame, root: str, checkpoint: str, now: Column | None = None,
                  max_articles: int | None = None, max_citations: int | None = None, limits: dict[str, int] | None = None,
                  deltas: int = store.DELTAS, buckets: int = store.BUCKETS) -> StreamingQuery:
    """Merge a stream of items into norms, versions, articles and citations by `merge_into`, one epoch per micro-batch.

    What is read and written follows the batch and not the tables. A batch that is run again overwrites only its own output.
    """
    now = F.current_timestamp() if now is None else now
    store.start(items.sparkSession, list(stores(root, buckets).values()))

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        merge_into(batch.sparkSession, root, batch, epoch, now, max_articles, max_citations, limits, deltas, buckets)

    return (
        items.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def dedup_stream(items: DataFrame, id: str, ts: str, root: str, checkpoint: str, within: str | None = None) -> StreamingQuery:
    """Appends the first row of each id under `root`/rows; rows with a null id are dropped.

    By default a row counts as a repeat however late it comes. The ids seen are keyed state in RocksDB, cut by hash over
    the state partitions: a micro-batch looks up its own ids and reads nothing of what was kept before. With
    `within` (such as "2 hours") an id is forgotten once the watermark has passed its first row by that much, and rows
    behind the watermark are dropped, so the state stays as small as the delay; `dedup_report` counts both kinds.
    Of several rows of an id in one micro-batch one is kept.
    """
    epochs.start(items.sparkSession, root, {"rows": items.schema})
    known = items.where(F.col(id).isNotNull())
    if within is None:
        fresh = known.dropDuplicates([id])
    else:
        timed = known.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", within)
        fresh = timed.dropDuplicatesWithinWatermark([id]).drop("_at")

    def keep(batch: DataFrame, epoch: int) -> None:
        epochs.write(batch, root, "rows", epoch)
        epochs.finish(batch.sparkSession, root, epoch)

    with keyed.rocksdb(items.sparkSession):
        return fresh.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedup_report(query: StreamingQuery) -> list[dict]:
    """Per micro-batch of a finished run of `dedup_stream`: batch, rows_in, repeats and late rows dropped, ids held as state."""
    out = []
    for progress in query.recentProgress:
        for state in progress["stateOperators"]:
            out.append({"batch": progress["batchId"], "rows_in": progress["numInputRows"], "repeats": state["customMetrics"].get("numDroppedDuplicateRows", 0),
                        "late": state["numRowsDroppedByWatermark"], "ids_held": state["numRowsTotal"]})
    return out


def deduplicated(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """What `dedup_stream` has let through so far."""
    return epochs.history(spark, root, "rows", schema).select(*schema.names)


def hash_state_stream(items: DataFrame, key: str, seq: str, hash: str, root: str, checkpoint: str) -> StreamingQuery:
    """Appends key, seq, outcome (added, updated, unchanged) to `root`/outcomes, against the last hash kept per key.

    The last hash of each key is keyed state in RocksDB (`keyed.LastHash`): a micro-batch looks up the keys it holds and
    hands each row on with the hash from before. What became of each row is then found among the rows
    of the micro-batch, a key's rows cut into slices along `seq`, so a hot key fills many tasks. Nothing written
    earlier is read. Null hashes equal each other; a null key is a key; `seq` holds no nulls.
    """
    types = {c: items.schema[c].dataType for c in (key, seq, hash)}
    outcome = T.StructType([T.StructField(key, types[key]), T.StructField(seq, types[seq]), T.StructField("outcome", T.StringType())])
    spark = items.sparkSession
    epochs.start(spark, root, {"outcomes": outcome})

    def judge(batch: DataFrame, epoch: int) -> None:
        # The state is read and renewed by one run over the batch; all that follows reads what that run wrote.
        rows = stage(batch, "with-last-hash")
        judged = lag_sliced(rows, ["key"], ["seq"], F.col("hash"), order_slices(rows, "seq"), "prev")
        first = F.col("prev").isNull()
        same = F.when(first, F.col("last_hash")).otherwise(F.col("prev.v")).eqNullSafe(F.col("hash"))
        made = F.when(first & ~F.col("known"), "added").when(same, "unchanged").otherwise("updated").alias("outcome")
        epochs.write(judged.select(F.col("key").alias(key), F.col("seq").alias(seq), made), root, "outcomes", epoch)
        epochs.finish(batch.sparkSession, root, epoch)

    with keyed.rocksdb(spark):
        return keyed.with_last_hash(items, key, seq, hash).writeStream.foreachBatch(judge).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def outcomes(spark: SparkSession, root: str, key: T.StructField, seq: T.StructField) -> DataFrame:
    """What `hash_state_stream` has judged so far."""
    schema = T.StructType([key, seq, T.StructField("outcome", T.StringType())])
    return epochs.history(spark, root, "outcomes", schema).select(*schema.names)


def complete_stream(stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """An aggregated stream whose whole result each micro-batch replaces; read it with `epochs.state`."""
    epochs.start(stream.sparkSession, root, {"result": stream.schema})
    return stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, epoch: epochs.replace(df, root, "result", epoch)).trigger(availableNow=True).start()


def _tally(valid: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid")]


def monitor_rate(items: DataFrame, ts: str, valid: Column, width: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Items, valid and invalid per tumbling window. Works on a stream and on a table."""
    timed = items.withColumn("_ts", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("_ts", delay) if items.isStreaming else timed
    return timed.groupBy(F.window("_ts", width).alias("w")).agg(*_tally(valid)).select(
        F.col("w.start").alias("window_start"), "n", "valid", "invalid"
    )


def monitor_recent(items: DataFrame, ts: str, valid: Column, width: str = "5 minutes", slide: str = "10 seconds",
                   delay: str = "10 minutes") -> DataFrame:
    """Items of the last `width`, renewed every `slide`: a true sliding view of what is recent.

    A table is first counted per slide, so that only counts, not rows, are
    copied into the overlapping windows; `slide` must divide `width`.
    """
    timed = items.withColumn("_ts", F.col(ts).cast("timestamp"))
    if items.isStreaming:
        counted = timed.withWatermark("_ts", delay).groupBy(F.window("_ts", width, slide).alias("w")).agg(*_tally(valid))
    else:
        steps = timed.groupBy(F.window("_ts", slide).alias("s")).agg(*_tally(valid))
        counted = steps.groupBy(F.window("s.start", width, slide).alias("w")).agg(*[F.sum(c).alias(c) for c in ("n", "valid", "invalid")])
    return counted.select(F.col("w.start").alias("window_start"), "n", "valid", "invalid")


def monitor_totals(rates: DataFrame) -> DataFrame:
    """Running total, new items and valid and invalid so far, from the counts per window."""
    from pyspark.sql import Window

    so_far = Window.orderBy("window_start")
    return rates.select(
        "window_start", F.col("n").alias("new"), F.sum("n").over(so_far).alias("total"),
        F.sum("valid").over(so_far).alias("valid"), F.sum("invalid").over(so_far).alias("invalid"),
    )
