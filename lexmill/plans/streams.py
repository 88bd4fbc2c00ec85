"""Streaming jobs run to the end of the landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.plans.corpus import ITEMS_SQL, items
from lexmill.plans.registry import query, table
from lexmill.session import scratch_path
from lexmill.streaming import epochs, jobs

_OUTCOMES = f"""items as (select *, sha256(raw_text) as text_hash from ({ITEMS_SQL})), lagged as (select *, lag(text_hash) over w as prev, row_number() over w as rn from items window w as (partition by url order by seq)),
outcomes as (select *, case when rn = 1 then 'added' when prev <> text_hash then 'updated' else 'unchanged' end as outcome from lagged)"""


def _events_stream(spark, sf, files_per_trigger=1000):
    return jobs.read_files(spark, f"{sf.rstrip('/')}/events.parquet", table(spark, sf, "events").schema, files_per_trigger=files_per_trigger)


def _run_complete(stream, spark):
    """Windows at their final state."""
    root = scratch_path(spark, "windows")
    jobs.complete_stream(stream, root, f"{root}/checkpoint").awaitTermination()
    return epochs.state(spark, root, "result", stream.schema)


def _ingested(spark, sf, name):
    root = scratch_path(spark, "ingest")
    jobs.ingest_stream(items(_events_stream(spark, sf)), root, f"{root}/checkpoint").awaitTermination()
    return jobs.snapshot(spark, root, name)


@query("x1_ingest_norms", f"""with {_OUTCOMES}, l as (select *, row_number() over (partition by url order by seq desc) as r from outcomes where outcome <> 'unchanged'), f as (select url, is_valid from outcomes where outcome = 'added')
select row_number() over (order by sha256(l.url)) as id, l.url, l.type, l.title, l.text_hash, f.is_valid from l join f on f.url = l.url where r = 1""")
def x1_ingest_norms(spark, sf):
    return _ingested(spark, sf, "norms").select("id", "url", "type", "title", "text_hash", "is_valid")


@query("x1_ingest_versions", f"with {_OUTCOMES} select text_hash, count(*) as n from outcomes where outcome <> 'unchanged' group by text_hash")
def x1_ingest_versions(spark, sf):
    return _ingested(spark, sf, "norm_versions").groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"))


@query("x1_ingest_citations", f"""with {_OUTCOMES}, l as (select *, row_number() over (partition by url order by seq desc) as r from outcomes where outcome <> 'unchanged')
select regexp_extract(raw_text, 'Ley N° \\d+') as target_text, 'modifies' as citation_type, count(*) as n from l where r = 1 group by all""")
def x1_ingest_citations(spark, sf):
    return _ingested(spark, sf, "norm_citations").groupBy("target_text", "citation_type").agg(F.count(F.lit(1)).alias("n"))


@query("x2_dedup", "select count(distinct event_id) as n, sum(distinct event_id)::bigint as total from events")
def x2_dedup(spark, sf):
    root, events = scratch_path(spark, "dedup"), _events_stream(spark, sf)
    jobs.dedup_stream(events, "event_id", "ts", root, f"{root}/checkpoint").awaitTermination()
    return jobs.deduplicated(spark, root, events.schema).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total"))


@query("x2_dedup_within", "select count(distinct event_id) as n, sum(distinct event_id)::bigint as total, count(*) filter (event_id is not null) - count(distinct event_id) as dropped from events")
def x2_dedup_within(spark, sf):
    """Deduplication with a watermark of a day, and how many rows it dropped."""
    root, events = scratch_path(spark, "dedup-within"), _events_stream(spark, sf)
    run = jobs.dedup_stream(events, "event_id", "ts", root, f"{root}/checkpoint", "1 day")
    run.awaitTermination()
    dropped = sum(r["repeats"] + r["late"] for r in jobs.dedup_report(run))
    kept = jobs.deduplicated(spark, root, events.schema)
    return kept.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total"), F.lit(dropped).cast("long").alias("dropped"))


@query("x3_hash_state_restarted", f"with {_OUTCOMES} select url, seq, outcome from outcomes")
def x3_hash_state_restarted(spark, sf):
    """The same in six micro-batches, the stream stopped and started again after each."""
    root, events = scratch_path(spark, "hash-state"), table(spark, sf, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = (high - low) // 6 + 1
    part = F.floor((F.col("event_id") - low) / step)
    for i in range(6):
        events.where(part == i).write.mode("append").parquet(f"{root}/landed")
        stream = items(jobs.read_files(spark, f"{root}/landed", events.schema, files_per_trigger=100_000))
        jobs.hash_state_stream(stream, "url", "seq", "text_hash", root, f"{root}/checkpoint").awaitTermination()
    return jobs.outcomes(spark, root, stream.schema["url"], stream.schema["seq"])


@query("x3_hash_state", f"with {_OUTCOMES} select url, seq, outcome from outcomes")
def x3_hash_state(spark, sf):
    root, stream = scratch_path(spark, "hash-state"), items(_events_stream(spark, sf))
    jobs.hash_state_stream(stream, "url", "seq", "text_hash", root, f"{root}/checkpoint").awaitTermination()
    return jobs.outcomes(spark, root, stream.schema["url"], stream.schema["seq"])


@query("x4_monitor_rate", """select date_trunc('minute', ts) as window_start, count(*) as n, count(*) filter (event_type <> 'error') as valid, count(*) filter (event_type = 'error') as invalid from events group by 1""")
def x4_monitor_rate(spark, sf):
    rates = jobs.monitor_rate(_events_stream(spark, sf), "ts", F.col("event_type") != "error")
    return _run_complete(rates, spark).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("x4_monitor_recent", """with s as (select event_type, unnest(generate_series(0, 29)) as i, time_bucket(interval '10 seconds', ts) as b from events)
select b - i * interval '10 seconds' as window_start, count(*) as n, count(*) filter (event_type <> 'error') as valid, count(*) filter (event_type = 'error') as invalid from s group by 1""")
def x4_monitor_recent(spark, sf):
    recent = jobs.monitor_recent(table(spark, sf, "events"), "ts", F.col("event_type") != "error")
    return recent.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("x4_monitor_recent_stream", """with s as (select event_type, unnest(generate_series(0, 4)) as i, date_trunc('minute', ts) as b from events)
select b - i * interval '1 minute' as window_start, count(*) as n, count(*) filter (event_type <> 'error') as valid, count(*) filter (event_type = 'error') as invalid from s group by 1""")
def x4_monitor_recent_stream(spark, sf):
    recent = jobs.monitor_recent(_events_stream(spark, sf), "ts", F.col("event_type") != "error", slide="1 minute")
    return _run_complete(recent, spark).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("x4_monitor_totals", """with r as (select date_trunc('minute', ts) as window_start, count(*) as n, count(*) filter (event_type <> 'error') as valid, count(*) filter (event_type = 'error') as invalid from events group by 1)
select window_start, n as new, cast(sum(n) over w as bigint) as total, cast(sum(valid) over w as bigint) as valid, cast(sum(invalid) over w as bigint) as invalid
from r window w as (order by window_start)""")
def x4_monitor_totals(spark, sf):
    rates = jobs.monitor_rate(table(spark, sf, "events"), "ts", F.col("event_type") != "error")
    return jobs.monitor_totals(rates).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
