"""Joins, merges, windows and set operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lexmill.operators import dataset, ingest, profile
from lexmill.operators.extract import extract_articles
from lexmill.plans.corpus import ARTICLES_SQL, ITEMS_SQL, NORMS_SQL, STORED_SQL, items, norms, stored_norms
from lexmill.plans.registry import ORACLE, query, table
from lexmill.schemas import VERSIONS, empty
from lexmill.session import scratch_path
from lexmill.sources import store
from lexmill.streaming import epochs, jobs

NOW = datetime(2026, 1, 1)


# Orders stand for versions of their customer, customers for norms.
def versions(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("norm_id"), F.col("o_orderdate").cast("timestamp").alias("version_date"),
        F.sha2(F.col("o_orderpriority"), 256).alias("text_hash"), F.col("o_orderpriority").alias("raw_text"))


def owners(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("type"), F.col("c_name").alias("number"))


@query("j1_latest", """with r as (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders)
select c.c_custkey as id, c.c_mktsegment as type, c.c_name as number, r.o_orderpriority as raw_text from customer c left join r on r.o_custkey = c.c_custkey and rn = 1""")
def j1_latest(spark, sf):
    return ingest.latest_version(owners(spark, sf), versions(spark, sf))


@query("j2_versions", "select o.o_orderkey as version_id, c.c_custkey as norm_id, c.c_mktsegment as type, o.o_orderpriority as raw_text from orders o join customer c on c.c_custkey = o.o_custkey")
def j2_versions(spark, sf):
    joined = ingest.versions_with_norms(versions(spark, sf), owners(spark, sf))
    return joined.select(F.col("v.id").alias("version_id"), F.col("n.id").alias("norm_id"), "n.type", "v.raw_text")


@query("j3_skip_known", "select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def j3_skip_known(spark, sf):
    return ingest.skip_known(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "lang")


@query("j4_with_detail", "select d.doc_id, d.lang, l.quality from documents d join labels l on l.doc_id = d.doc_id")
def j4_with_detail(spark, sf):
    from lexmill.sources.landing import with_detail

    return with_detail(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "lang", "quality")


OUTCOMES_SQL = f"""stored as (select *, sha256(old_text) as last_hash from ({STORED_SQL})), items as (select *, sha256(raw_text) as text_hash from ({ITEMS_SQL})),
lagged as (select i.*, lag(text_hash) over w as prev, row_number() over w as rn from items i window w as (partition by url order by seq)),
outcomes as (select l.*, s.id as known_id, case when rn = 1 and s.id is null then 'added'
   when (case when rn = 1 then s.last_hash else prev end) <> text_hash then 'updated' else 'unchanged' end as outcome
   from lagged l left join stored s on s.url = l.url),
changed as (select * from outcomes where outcome <> 'unchanged'),
fresh as (select url, (select max(id) from stored) + row_number() over (order by sha256(url)) as id from (select distinct url from outcomes where known_id is null)),
ids as (select url, id from stored union all select url, id from fresh),
last as (select * from (select *, row_number() over (partition by url order by seq desc) as r from changed) where r = 1),
first as (select * from changed where outcome = 'added')"""


@query("j5_outcomes", f"with {OUTCOMES_SQL} select o.url, o.seq, o.outcome, ids.id as norm_id from outcomes o join ids on ids.url = o.url")
def j5_outcomes(spark, sf):
    merged = ingest.merge_versions(stored_norms(spark, sf), empty(spark, VERSIONS), items(table(spark, sf, "events")), NOW)
    return merged.outcomes.select("url", "seq", "outcome", "norm_id")


@query("j5_merge", f"""with {OUTCOMES_SQL}
select ids.id, ids.url, case when l.url is null then s.type else l.type end as type, case when l.url is null then s.title else l.title end as title,
 case when l.url is null then null else l.status end as status, case when l.url is null then s.level else l.level end as level,
 case when s.id is null then f.is_valid else s.is_valid end as is_valid, case when s.id is null and f.is_valid = 0 then f.status end as validation_message,
 coalesce(l.text_hash, s.last_hash) as last_hash
from ids left join stored s on s.url = ids.url left join last l on l.url = ids.url left join first f on f.url = ids.url""")
def j5_merge(spark, sf):
    merged = ingest.merge_versions(stored_norms(spark, sf), empty(spark, VERSIONS), items(table(spark, sf, "events")), NOW)
    return merged.norms.select("id", "url", "type", "title", "status", "level", "is_valid", "validation_message", "last_hash")


@query("j5_versions", f"""with {OUTCOMES_SQL} select row_number() over (order by sha256(concat(c.url, '|', cast(c.seq as varchar)))) as id, ids.id as norm_id, c.text_hash, c.raw_text
 from changed c join ids on ids.url = c.url""")
def j5_versions(spark, sf):
    merged = ingest.merge_versions(stored_norms(spark, sf), empty(spark, VERSIONS), items(table(spark, sf, "events")), NOW)
    return merged.versions.select("id", "norm_id", "text_hash", "raw_text")


@query("j5_again", "select 'unchanged' as outcome, count(distinct user_id) as n from events")
def j5_again(spark, sf):
    """Merging the newest state of every link a second time changes nothing."""
    batch = items(table(spark, sf, "events"))
    once = ingest.merge_versions(stored_norms(spark, sf), empty(spark, VERSIONS), batch, NOW)
    newest = batch.groupBy("url").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "url"]), "seq").alias("i")).select("url", "i.*")
    twice = ingest.merge_versions(once.norms, once.versions, newest, NOW)
    return ingest.outcome_totals(twice.outcomes)


def _merged_store(spark, sf):
    """Norms stored as epoch 0, and a batch of items merged into them as epoch 1."""
    root = scratch_path(spark, "norm-store")
    tables = jobs.stores(root)
    store.start(spark, list(tables.values()))
    store.write(stored_norms(spark, sf), tables["norms"], 0)
    epochs.finish(spark, root, 0)
    outcomes = jobs.merge_into(spark, root, items(table(spark, sf, "events")), 1, F.lit(NOW).cast("timestamp"))
    return tables, outcomes


@query("j5_store_merge", ORACLE["j5_merge"])
def j5_store_merge(spark, sf):
    """The same merge into stored buckets, of which only the touched ones are read and only changed norms written."""
    tables, _ = _merged_store(spark, sf)
    return store.read(spark, tables["norms"]).select("id", "url", "type", "title", "status", "level", "is_valid", "validation_message", "last_hash")


@query("j5_store_versions", ORACLE["j5_versions"])
def j5_store_versions(spark, sf):
    tables, _ = _merged_store(spark, sf)
    return store.read(spark, tables["norm_versions"]).select("id", "norm_id", "text_hash", "raw_text")


@query("j5_store_as_of", f"select id, url, level, sha256(old_text) as last_hash from ({STORED_SQL})")
def j5_store_as_of(spark, sf):
    """The stored norms as they were before the merge, read after it and after a compaction."""
    tables, _ = _merged_store(spark, sf)
    store.compact(spark, tables["norms"], 1)
    return store.read(spark, tables["norms"], 0).select("id", "url", "level", "last_hash")


@query("j6_replace", """with old as (select conv_id as norm_id, turn, role from conversations), changed as (select distinct conv_id as norm_id from conversations where conv_id % 3 = 0),
new as (select conv_id as norm_id, turn, upper(role) as role from conversations where conv_id % 6 = 0)
select * from old where norm_id not in (select norm_id from changed where norm_id in (select norm_id from new)) union all select * from new""")
def j6_replace(spark, sf):
    """Every third conversation changed, every sixth yielded new rows; the rest keep their old ones."""
    old = table(spark, sf, "conversations").select(F.col("conv_id").alias("norm_id"), "turn", "role")
    changed = old.where("norm_id % 3 = 0")
    new = old.where("norm_id % 6 = 0").withColumn("role", F.upper("role"))
    return ingest.replace_children(old, new, changed)


@query("j6_store_replace", ORACLE["j6_replace"])
def j6_store_replace(spark, sf):
    """Children in stored buckets: those written last stand for their parent."""
    old = table(spark, sf, "conversations").select(F.col("conv_id").alias("norm_id"), "turn", "role")
    children = store.Store(scratch_path(spark, "child-store"), "turns", old.schema, "norm_id")
    store.start(spark, [children])
    store.write(old, children, 0)
    store.write(old.where("norm_id % 6 = 0").withColumn("role", F.upper("role")), children, 1)
    return store.read(spark, children, 1)


@query("j6_replace_articles", f"""with norms as ({NORMS_SQL}), arts as ({ARTICLES_SQL}), changed as (select id from norms where id % 2 = 0)
select id as norm_id, cast("order" as varchar) as number, case when id in (select id from changed) then upper(content) else content end as content, "order" from arts""")
def j6_replace_articles(spark, sf):
    n = norms(spark, sf).withColumnRenamed("id", "norm_id")
    changed = n.where("norm_id % 2 = 0")
    new = extract_articles(changed.withColumn("raw_text", F.upper("raw_text")), "norm_id", "raw_text")
    return ingest.replace_children(extract_articles(n, "norm_id", "raw_text"), new, changed)


_FOUND_SQL = """t as (select number, regexp_extract(number, '(\\d+)', 1) as token from (select distinct concat(lpad(cast(p_partkey % 1500 as varchar), 3, '0'), '-', cast(1992 + p_partkey % 7 as varchar)) as number from part)),
d as (select id, upper(concat(title, ' N° ', number)) as title, regexp_extract(number, '(\\d+)', 1) as token from norms)"""


@query("j10_find", f"""with norms as ({NORMS_SQL}), {_FOUND_SQL}, h as (select t.number, min(d.id) as id from t join d on d.token = t.token and contains(d.title, upper(t.number)) group by t.number)
select t.number, h.id, h.id is not null as found from t left join h on h.number = t.number""")
def j10_find(spark, sf):
    number = F.concat_ws("-", F.lpad((F.col("p_partkey") % 1500).cast("string"), 3, "0"), (1992 + F.col("p_partkey") % 7).cast("string"))
    targets = table(spark, sf, "part").select(number.alias("number")).distinct()
    docs = norms(spark, sf).withColumn("title", F.concat_ws(" N° ", "title", "number"))
    return profile.find_by_number(targets, docs, "id")


# --- Windows ----------------------------------------------------------------------

_STATE_SQL = "select o_orderkey as id, o_custkey as norm_id, case when row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1 then 'Inicial' else 'Modificado' end as state from orders"


@query("w1_version_state", _STATE_SQL)
def w1_version_state(spark, sf):
    return ingest.version_state(versions(spark, sf)).select("id", "norm_id", "state")


@query("w1_version_listing", f"""with s as ({_STATE_SQL}) select o.o_orderkey as id, trim(concat(c.c_mktsegment, ' ', c.c_name)) as norm, strftime(o.o_orderdate, '%Y-%m-%d') as version_day,
 concat(left(sha256(o.o_orderpriority), 10), '...') as hash, s.state from orders o join customer c on c.c_custkey = o.o_custkey join s on s.id = o.o_orderkey""")
def w1_version_listing(spark, sf):
    state = ingest.version_state(versions(spark, sf))
    joined = ingest.versions_with_norms(state, owners(spark, sf)).select("v.*", "n.type", "n.number")
    return profile.newest_first(profile.display_versions(joined), "version_day")


@query("w2_changes", """with l as (select *, lag(props) over (partition by user_id order by event_id) as prev, row_number() over (partition by user_id order by event_id) as rn from events)
select event_id, user_id, props from l where rn = 1 or prev <> props""")
def w2_changes(spark, sf):
    return ingest.change_points(table(spark, sf, "events"), ["user_id"], ["event_id"], "props").select("event_id", "user_id", "props")


_PLAN = [("en", "1"), ("en", "2"), ("fr", "1"), ("de", "2"), ("es", "1"), ("en", "1")]


def _quota_sql(per_entry: int, target: int) -> str:
    """Entry by entry, each leaving out what the earlier ones took."""
    parts = []
    for i, (lang, how) in enumerate(_PLAN):
        taken = " and doc_id not in (" + " union all ".join(f"select doc_id from e{j}" for j in range(i)) + ")" if i else ""
        order = "desc" if how == "1" else "asc"
        parts.append(f"""e{i} as (select doc_id, {i} as entry, row_number() over (order by day {order}, doc_id) as rank from d where lang = '{lang}'{taken}
          order by day {order}, doc_id limit {per_entry})""")
    union = " union all ".join(f"select * from e{i}" for i in range(len(_PLAN)))
    return f"""with d as (select doc_id, lang, date '2020-01-01' + cast(n_chars % 1500 as integer) as day from documents), {', '.join(parts)}, u as ({union})
      select doc_id, entry, rank from u order by entry, rank limit {target}"""


@query("w3_quota", _quota_sql(60, 250))
def w3_quota(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("n_chars") % 1500).cast("int")).alias("day"))
    return ingest.quota_sample(docs, "doc_id", "lang", "day", _PLAN, 60, 250)


@query("w4_changes", f"""with norms as ({NORMS_SQL}) select id, case when is_valid = 0 and id % 4 <> 0 then 'to_valid' when is_valid = 1 and id % 4 = 0 then 'to_invalid' else 'none' end as change from norms""")
def w4_changes(spark, sf):
    n = norms(spark, sf).withColumn("now_valid", F.when(F.col("id") % 4 == 0, 0).otherwise(1))
    return ingest.validity_changes(n, "is_valid", "now_valid").select("id", "change")


@query("w4_history", """with e as (select event_id, user_id, case when event_type = 'error' then 0 else 1 end as v from events),
l as (select *, lag(v) over (partition by user_id order by event_id) as o from e)
select event_id, case when o = 0 and v = 1 then 'to_valid' when o = 1 and v = 0 then 'to_invalid' else 'none' end as change from l""")
def w4_history(spark, sf):
    e = table(spark, sf, "events").withColumn("valid", (F.col("event_type") != "error").cast("int"))
    return ingest.validity_history(e, ["user_id"], ["event_id"], "valid").select("event_id", "change")


@query("w5_first_seen", "select text, doc_id, lang from (select *, row_number() over (partition by text order by lang, doc_id) as rn from documents) where rn = 1")
def w5_first_seen(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang", "doc_id")
    return ingest.first_seen(docs, "text", ["lang", "doc_id"])


# --- Sets -------------------------------------------------------------------------

@query("u1_stack", "select doc_id, quality from labels where quality = 0 union all select doc_id, quality from labels where quality = 1")
def u1_stack(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return dataset.stack(labels.where("quality = 0"), labels.where("quality = 1"))


@query("u2_distinct", "select source, lang, min(doc_id) as doc_id from documents group by source, lang")
def u2_distinct(spark, sf):
    docs = table(spark, sf, "documents").select("source", "lang", "doc_id")
    return profile.distinct_first(docs, ["source", "lang"], ["doc_id"])
