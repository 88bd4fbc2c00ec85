"""Streams stopped and started again end where one batch would."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lexmill import schemas
from lexmill.operators import ingest
from lexmill.streaming import jobs

ITEM = schemas.fields(
    url="string!", seq="long", type="string", number="string", title="string", date="date", source="string", status="string",
    is_valid="int", level="int", text_hash="string", raw_text="string")


def land(spark, folder, rows):
    """One more landed file of items: (url, seq, version of the text)."""
    data = [(u, s, "LEY", None, f"t{s}", None, None, "VIGENTE", 1, 2, v, f"Artículo 1.- Modifica la Ley N° {v}." if v != "0" else "sin artículos")
            for u, s, v in rows]
    spark.createDataFrame(data, ITEM).coalesce(1).write.mode("append").parquet(folder)


ROWS = [[("a", 0, "1"), ("b", 1, "1"), ("a", 2, "1"), ("a", 3, "2")], [("a", 4, "2"), ("b", 5, "0"), ("c", 6, "3")], [("c", 7, "3"), ("a", 8, "1")]]


def test_ingest_resumes(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    for rows in ROWS:
        land(spark, landing, rows)
        jobs.ingest_stream(jobs.read_files(spark, landing, ITEM), root, state).awaitTermination()
    tables = {name: jobs.snapshot(spark, root, name) for name in jobs.STREAM_TABLES}
    whole = ingest.merge_versions(
        schemas.empty(spark, schemas.NORMS), schemas.empty(spark, schemas.VERSIONS),
        spark.read.schema(ITEM).parquet(landing), F.current_timestamp())
    cols = ["url", "title", "text_hash", "is_valid", "last_hash"]
    assert sorted(map(tuple, tables["norms"].select(cols).collect())) == sorted(map(tuple, whole.norms.select(cols).collect()))
    assert tables["norm_versions"].count() == whole.versions.count() == 6
    ids = {r["url"]: r["id"] for r in tables["norms"].collect()}
    arts = {r["norm_id"]: r["content"] for r in tables["norm_articles"].collect()}
    # b's newest text has no article, so its old one stays.
    assert arts == {ids["a"]: "Artículo 1.- Modifica la Ley N° 1.", ids["b"]: "Artículo 1.- Modifica la Ley N° 1.", ids["c"]: "Artículo 1.- Modifica la Ley N° 3."}
    assert {r["target_text"] for r in tables["norm_citations"].collect()} == {"Ley N° 1", "Ley N° 3"}


def test_hash_state_survives_restart(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("landing", "root", "state"))
    for rows in ROWS:
        land(spark, landing, rows)
        jobs.hash_state_stream(jobs.read_files(spark, landing, ITEM), "url", "seq", "text_hash", root, state).awaitTermination()
    got = {r["seq"]: r["outcome"] for r in jobs.outcomes(spark, root, ITEM["url"], ITEM["seq"]).collect()}
    assert got == {0: "added", 1: "added", 2: "unchanged", 3: "updated", 4: "unchanged", 5: "updated", 6: "added", 7: "unchanged", 8: "updated"}


def test_hash_state_takes_null_hashes_as_equal(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    schema = schemas.fields(k="string", seq="long", h="string")
    for rows in ([("a", 0, None), ("a", 1, None)], [("a", 2, None), ("a", 3, "x")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        jobs.hash_state_stream(jobs.read_files(spark, landing, schema), "k", "seq", "h", root, str(tmp_path / "state")).awaitTermination()
    got = {r["seq"]: r["outcome"] for r in jobs.outcomes(spark, root, schema["k"], schema["seq"]).collect()}
    assert got == {0: "added", 1: "unchanged", 2: "unchanged", 3: "updated"}


def test_dedup_lets_no_late_repeat_through(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("landing", "root", "state"))
    schema = schemas.fields(id="long", ts="timestamp")
    # The second file lies hours before the first, the third repeats it a day later.
    for first, at in ((5, 1_700_100_000), (0, 1_700_000_000), (3, 1_700_200_000)):
        spark.range(first, first + 10).select("id", F.timestamp_seconds(F.col("id") + at).alias("ts")).coalesce(1).write.mode("append").parquet(landing)
        jobs.dedup_stream(jobs.read_files(spark, landing, schema), "id", "ts", root, state).awaitTermination()
    assert sorted(r["id"] for r in jobs.deduplicated(spark, root, schema).collect()) == list(range(15))


@pytest.mark.parametrize("files, per_trigger", [(1, 1000), (4, 1000), (2, 1), (3, 1)])
def test_streams_over_folders_and_micro_batches(spark, sf_dir, tmp_path, monkeypatch, files, per_trigger):
    """A table as one file, as a folder of parts, and in two or three micro-batches gives the same."""
    from lexmill.plans import streams

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = str(tmp_path / "sf")
    events.repartition(files, "event_id").write.parquet(f"{folder}/events.parquet")
    whole = streams._events_stream
    monkeypatch.setattr(streams, "_events_stream", lambda s, sf: whole(s, sf, per_trigger))
    totals = events.agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids")).first()
    assert streams.x4_monitor_rate(spark, folder).agg(F.sum("n")).first()[0] == totals["n"]
    assert streams.x2_dedup(spark, folder).first()["n"] == totals["ids"]
    assert streams.x3_hash_state(spark, folder).count() == totals["n"]
    if files == 3:
        assert streams.x1_ingest_norms(spark, folder).count() == events.select("user_id").distinct().count()


def events(spark):
    return spark.range(200).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("ts"), (F.col("id") % 5 != 0).alias("ok"))


@pytest.mark.parametrize("slide", ["10 seconds", "1 minute"])
def test_sliding_counts_equal_direct_windows(spark, slide):
    direct = events(spark).groupBy(F.window("ts", "5 minutes", slide).alias("w")).agg(F.count("*").alias("n"), F.count_if("ok").alias("valid"))
    expected = sorted((r["s"], r["n"], r["valid"]) for r in direct.select(F.col("w.start").alias("s"), "n", "valid").collect())
    got = jobs.monitor_recent(events(spark), "ts", F.col("ok"), slide=slide)
    assert sorted((r["window_start"], r["n"], r["valid"]) for r in got.collect()) == expected


def test_totals_run_up_to_the_whole(spark):
    rates = jobs.monitor_rate(events(spark), "ts", F.col("ok"))
    last = jobs.monitor_totals(rates).orderBy(F.desc("window_start")).first()
    assert (last["total"], last["valid"], last["invalid"]) == (200, 160, 40)


def test_hash_state_over_many_batches_reads_no_history(spark, tmp_path):
    """Six micro-batches, with a restart after each second one, against one pass; only keyed state is kept, one entry a key."""
    landing, root, state = (str(tmp_path / n) for n in ("landing", "root", "state"))
    schema = schemas.fields(k="string", seq="long", h="string")
    rng = random.Random(3)
    rows = [(rng.choice("abcdefghij") if i % 7 else None, i, rng.choice(["1", "2", None])) for i in range(600)]
    for i in range(6):
        spark.createDataFrame(rows[i * 100:(i + 1) * 100], schema).coalesce(1).write.mode("append").parquet(landing)
        if i % 2:
            query = jobs.hash_state_stream(jobs.read_files(spark, landing, schema, files_per_trigger=1), "k", "seq", "h", root, state)
            query.awaitTermination()
    expected, last = {}, {}
    for k, seq, h in rows:
        expected[seq] = "added" if k not in last else "unchanged" if last[k] == h else "updated"
        last[k] = h
    assert {r["seq"]: r["outcome"] for r in jobs.outcomes(spark, root, schema["k"], schema["seq"]).collect()} == expected
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == len(last)
    assert query.lastProgress["numInputRows"] == 100
    assert sorted(os.listdir(root)) == ["_finished", "outcomes"]


@pytest.mark.parametrize("within", [None, "10 minutes"])
def test_dedup_counts_repeats_and_late_rows(spark, tmp_path, within):
    """(id, minute): 1 repeats at once and after an hour, 9 comes late; the file after tells the watermark."""
    landing, root, state = (str(tmp_path / n) for n in ("landing", "root", "state"))
    schema = schemas.fields(id="long", ts="timestamp")
    reports = []
    for rows in ([(1, 0), (2, 1), (None, 1)], [(1, 5), (3, 60)], [(4, 61)], [(1, 62), (9, 3)]):
        spark.createDataFrame([(i, 1_700_000_000 + 60 * m) for i, m in rows], "id long, m long").select("id", F.timestamp_seconds("m").alias("ts")).coalesce(1).write.mode("append").parquet(landing)
        query = jobs.dedup_stream(jobs.read_files(spark, landing, schema, files_per_trigger=1), "id", "ts", root, state, within)
        query.awaitTermination()
        reports += jobs.dedup_report(query)
    kept = sorted(r["id"] for r in jobs.deduplicated(spark, root, schema).collect())
    repeats, late = (sum(r[c] for r in reports) for c in ("repeats", "late"))
    if within is None:
        assert kept == [1, 2, 3, 4, 9] and (repeats, late) == (2, 0) and reports[-1]["ids_held"] == 5
    else:
        assert kept == [1, 1, 2, 3, 4] and (repeats, late) == (1, 1) and reports[-1]["ids_held"] <= 3
