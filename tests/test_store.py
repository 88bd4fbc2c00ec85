"""Bucketed tables against plain dictionaries: merges, older epochs, compaction, what is written."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lexmill import schemas
from lexmill.sources import store
from lexmill.streaming import epochs, jobs

SCHEMA = schemas.fields(k="long", v="string", n="long")


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("append", [False, True])
def test_epochs_read_as_they_were_before_during_and_after_compaction(spark, tmp_path, append):
    rng = random.Random(7)
    table = store.Store(str(tmp_path), "t", SCHEMA, "k", append=append, counter="n", buckets=5)
    store.start(spark, [table])
    assert store.read(spark, table).count() == 0
    with pytest.raises(ValueError):
        store.start(spark, [table._replace(buckets=6)])
    live, states = {}, []
    for epoch in range(4):
        # Each epoch writes one to three rows for some keys, a null key among them.
        keys = rng.sample([None, *range(40)], 12) if epoch else [None, *range(40)]
        new = {k: [(k, f"{epoch}-{i}", epoch * 100 + i) for i in range(rng.randint(1, 3))] for k in keys}
        for k, rows in new.items():
            live[k] = live.get(k, []) + rows if append else rows
        df = spark.createDataFrame([r for rows in new.values() for r in rows], SCHEMA)
        parts = store.write(df, table, epoch, deltas=2)
        epochs.finish(spark, str(tmp_path), epoch)
        assert max(sum(p.kind == "delta" and p.bucket == b for p in parts) for b in range(5)) <= 2
        assert store.highest(parts) == max(r[2] for rows in live.values() for r in rows)
        states.append(sorted([r for rows in live.values() for r in rows], key=repr))
    assert [rows_of(store.read(spark, table, e)) for e in range(4)] == states
    store.compact(spark, table, 3)
    assert all(p.kind == "base" for p in store.manifest(spark, table, 3))
    assert [rows_of(store.read(spark, table, e)) for e in range(4)] == states
    some = store.read(spark, table, buckets=[1, 2])
    assert rows_of(some) == rows_of(store.read(spark, table).where(table.bucket(F.col("k")).isin(1, 2)))
    assert store.vacuum(spark, table, keep=2)
    assert [rows_of(store.read(spark, table, e)) for e in (2, 3)] == states[2:] and store.vacuum(spark, table, keep=2) == []


def test_a_change_of_one_percent_writes_about_one_percent(spark, tmp_path):
    table = store.Store(str(tmp_path), "t", SCHEMA, "k", buckets=8)
    store.start(spark, [table])
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.col("id").alias("n"))
    store.write(rows, table, 0)
    whole = size(f"{table.path}/kind=delta/epoch=0")
    parts = store.write(rows.where("k % 100 = 7").withColumn("v", F.sha2("v", 256)), table, 1)
    assert size(f"{table.path}/kind=delta/epoch=1") < 0.02 * whole and not os.path.exists(f"{table.path}/kind=base")
    assert len(parts) == 16 and store.read(spark, table, 1).count() == 200_000
    assert store.read(spark, table, 1).join(rows, ["k", "v"], "left_semi").count() == 198_000


def test_an_unfinished_epoch_is_not_seen_and_can_be_written_again(spark, tmp_path):
    table = store.Store(str(tmp_path), "t", SCHEMA, "k", buckets=3)
    store.start(spark, [table])
    one, two, three = (spark.createDataFrame([(1, v, 1)], SCHEMA) for v in "abc")
    store.write(one, table, 0)
    epochs.finish(spark, str(tmp_path), 0)
    store.write(two, table, 1)
    assert rows_of(store.read(spark, table)) == [(1, "a", 1)]
    store.write(three, table, 1)
    epochs.finish(spark, str(tmp_path), 1)
    assert rows_of(store.read(spark, table)) == [(1, "c", 1)] and rows_of(store.read(spark, table, 0)) == [(1, "a", 1)]
    store.write(schemas.empty(spark, SCHEMA), table, 2)
    assert rows_of(store.read(spark, table, 2)) == [(1, "c", 1)]


def test_ingest_in_many_batches_compacts_and_equals_one(spark, tmp_path):
    from test_streaming import ITEM, land

    rng, landing, root = random.Random(9), str(tmp_path / "landing"), str(tmp_path / "root")
    rows = [(rng.choice("abc"), i, rng.choice("0123")) for i in range(36)]
    for i in range(3):
        land(spark, landing, rows[i * 12:i * 12 + 12])
        jobs.ingest_stream(jobs.read_files(spark, landing, ITEM, files_per_trigger=1), root, str(tmp_path / "state"), deltas=1).awaitTermination()
    whole = str(tmp_path / "whole")
    store.start(spark, list(jobs.stores(whole).values()))
    jobs.merge_into(spark, whole, spark.read.schema(ITEM).parquet(landing), 0, F.current_timestamp())
    cols = {"norms": ["url", "title", "text_hash", "is_valid", "last_hash"], "norm_versions": ["text_hash", "raw_text"], "norm_articles": ["content"]}
    for name, wanted in cols.items():
        a, b = (rows_of(jobs.snapshot(spark, r, name).select(*wanted)) for r in (root, whole))
        if name != "norm_articles":
            assert a == b and a
        parts = store.manifest(spark, jobs.stores(root)[name], epochs.latest(spark, root))
        assert any(p.kind == "base" for p in parts) and len(parts) == len({(p.bucket, p.kind) for p in parts})
    ids = [r["id"] for r in jobs.snapshot(spark, root, "norm_versions").collect()]
    assert len(set(ids)) == len(ids) == max(ids)
