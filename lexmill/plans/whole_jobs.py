"""Whole jobs over the derived corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill import jobs, schemas
from lexmill.functions.rules import with_level
from lexmill.operators import classify, features, irmetrics, retrieval
from lexmill.plans.corpus import ARTICLES_SQL, CODE_BLOCKS_SQL, NORMS_SQL, codes, norms
from lexmill.plans.generators import CITATIONS_SQL
from lexmill.plans.learning import TFIDF_SQL, VOCAB
from lexmill.plans.registry import query, table, wide_table
from lexmill.plans.scalars import LEVEL_SQL
from lexmill.plans.scans import details, search_documents
from lexmill.plans.search import _MEAN, _QSET_SQL, _hashed_sql, _ranked_sql, bm25_sql, metrics_sql
from lexmill.session import scratch_path
from lexmill.sources import tables


def _now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def _stored(spark, sf):
    """The derived norms as stored tables with one version each."""
    n = with_level(norms(spark, sf)).withColumnsRenamed({"updated": "updated_at"})
    shaped = n.withColumns({"updated_at": F.col("updated_at").cast("timestamp"), "status": F.lit("VIGENTE"),
                            "validation_date": F.when(F.col("id") % 3 != 0, F.col("updated_at").cast("timestamp"))})
    versions = n.select("id", F.col("id").alias("norm_id"), _now().alias("version_date"), F.sha2("raw_text", 256).alias("text_hash"), "raw_text")
    return schemas.conform(shaped, schemas.NORMS), schemas.conform(versions, schemas.VERSIONS)


def _ingested(spark, sf):
    empty = jobs.Corpus(*[schemas.empty(spark, schemas.TABLES[t]) for t in ("norms", "norm_versions", "norm_articles", "norm_citations")])
    docs = search_documents(spark, sf).withColumn("seq", F.substring("id", 2, 20).cast("long"))
    return jobs.ingest_batch(empty, docs, details(spark, sf), _now())


_IDS_SQL = f"""norms as ({NORMS_SQL}), arts as ({ARTICLES_SQL}), ids as (select id as k, row_number() over (order by sha256(url)) as norm_id from norms where is_valid is not null)"""


@query("k1_ingest_articles", f"""with {_IDS_SQL} select norm_id, cast(a."order" as varchar) as number, content, a."order" from arts a join ids on ids.k = a.id""")
def k1_ingest_articles(spark, sf):
    """Documents and details through items, merge and extraction."""
    return _ingested(spark, sf).articles


@query("k1_ingest_citations", f"""with {_IDS_SQL}, {CITATIONS_SQL} select norm_id, target_text, citation_type, source_type, c."order" from citations c join ids on ids.k = c.id""")
def k1_ingest_citations(spark, sf):
    return _ingested(spark, sf).citations


@query("k2_validate", f"""with norms as ({NORMS_SQL}) select id, case when id % 10 < 2 then 0 else 1 end as new_valid,
 case when is_valid = 0 and id % 10 >= 2 then 'to_valid' when is_valid = 1 and id % 10 < 2 then 'to_invalid' else 'none' end as change
 from norms where is_valid is null or id % 3 = 0""")
def k2_validate(spark, sf):
    """Norms without a validation, judged by their newest text."""
    n, v = _stored(spark, sf)
    return jobs.validate(n, v, _now()).select("id", "new_valid", "change")


@query("k2_revalidated", f"""with norms as ({NORMS_SQL}) select case when id % 10 < 2 then 0 else 1 end as is_valid, count(*) as n from norms group by 1""")
def k2_revalidated(spark, sf):
    n, v = _stored(spark, sf)
    return jobs.apply_validation(n, jobs.validate(n, v, _now(), force=True)).groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"))


@query("k3_list_versions", f"""with norms as ({NORMS_SQL}) select id, concat(type, ' ', number) as norm, '2026-01-01' as version_day, concat(left(sha256(raw_text), 10), '...') as hash, 'Inicial' as state from norms""")
def k3_list_versions(spark, sf):
    return jobs.list_versions(*_stored(spark, sf))


DIM = 64
_TEXT_SQL = f"""norms as ({NORMS_SQL}), lev as ({LEVEL_SQL}), idx as (select id as norm_id, title, is_valid, level, concat_ws('. ', type, concat('N° ', number), title, trim(regexp_replace(raw_text, '\\s+', ' ', 'g'))) as text
  from lev where is_valid = 1)"""


@query("k4_index_rows", f"with {_TEXT_SQL} select norm_id, title, level, text from idx")
def k4_index_rows(spark, sf):
    return jobs.index_rows(*_stored(spark, sf)).select("norm_id", "title", "level", "text")


def _benchmark_like_queries(spark, sf):
    """One query per market segment and nation: words that stand in titles and texts."""
    c = table(spark, sf, "customer").select(
        (F.col("c_nationkey") % 25).alias("query_id"),
        F.concat(F.lit("norma sobre la entidad "), (F.col("c_nationkey") * 3).cast("string"), F.lit(" modifica la ley")).alias("query"))
    return c.distinct()


_QUERY_SQL = "qs as (select distinct c_nationkey % 25 as query_id, concat('norma sobre la entidad ', c_nationkey * 3, ' modifica la ley') as query from customer)"


def _index(spark, sf):
    """The index written, and loaded for search as a later session would."""
    path = scratch_path(spark, "index")
    tables.write_index(jobs.build_index(*_stored(spark, sf), encoder=retrieval.hashed_terms_encoder(DIM)), path)
    return tables.load_index(spark, path)


@query("s14_load_index", f"with {_TEXT_SQL} select norm_id, title, level, {DIM} as width from idx")
def s14_load_index(spark, sf):
    return _index(spark, sf).select("norm_id", "title", "level", F.size("embedding").alias("width"))


@query("k5_search", f"""with {_TEXT_SQL}, {_QUERY_SQL}, {_hashed_sql('e', 'idx', 'norm_id', 'text')}, {_hashed_sql('q', 'qs', 'query_id', 'query')},
ds as (select q.id as query_id, e.id as doc_id, round(sum(q.x * e.x), 9) as score, 0 as label from q join e using (d) group by q.id, e.id)
select query_id, doc_id, round(score, 5) as score, rank, idx.title from {_ranked_sql('ds', 5)} t join idx on idx.norm_id = t.doc_id""")
def k5_search(spark, sf):
    hits = jobs.search(_index(spark, sf), _benchmark_like_queries(spark, sf), encoder=retrieval.hashed_terms_encoder(DIM))
    return hits.select("query_id", "doc_id", F.round("score", 5).alias("score"), "rank", "title")


@query("k5_search_bm25", f"""with {_TEXT_SQL}, {_QUERY_SQL}, {bm25_sql('idx', 'norm_id', 'title', 'qs', 'query_id', 'query', 5)}
select query_id, doc_id, round(score, 5) as score, rank, idx.title from bm25 join idx on idx.norm_id = bm25.doc_id""")
def k5_search_bm25(spark, sf):
    hits = jobs.search_bm25(_index(spark, sf), _benchmark_like_queries(spark, sf))
    return hits.select("query_id", "doc_id", F.round("score", 5).alias("score"), "rank", "title")


_K6_SQL = f"""{_TEXT_SQL}, {_QSET_SQL}, kw as (select query_id, keywords from eval), {_hashed_sql('e', 'idx', 'norm_id', 'text')}, {_hashed_sql('q', 'eval', 'query_id', 'query')},
ds as (select q.id as query_id, e.id as doc_id, round(sum(q.x * e.x), 9) as score, 0 as label from q join e using (d) group by q.id, e.id),
{bm25_sql('idx', 'norm_id', 'title', 'eval', 'query_id', 'query', 5)}, {metrics_sql('norms', 'id', 'title', 'type')}"""


@query("k6_evaluate_search", f"with {_K6_SQL} {_MEAN}")
def k6_evaluate_search(spark, sf):
    """The fixed evaluation set on the derived norms."""
    out = jobs.evaluate_search(_index(spark, sf), irmetrics.evaluation_queries(spark), encoder=retrieval.hashed_terms_encoder(DIM))
    return out.withColumns({c: F.round(c, 6) for c in ("dense", "bm25", "gain")})


_SAMPLE = "concat(code_id, '#', cast(\"order\" - 1 as varchar))"


@query("k7_validity_dataset", f"""with {CODE_BLOCKS_SQL}, s as (select code_id, article_num, {_SAMPLE} as sample_id, case when contains(block, '(*)') then 0 else 1 end as label from blocks)
select code_id, article_num, label from s where label = 0 union all
select code_id, article_num, label from (select * from s where label = 1 order by md5(concat(sample_id, '|42')) limit (select cast(floor(count(*) * 1.5) as bigint) from s where label = 0))""")
def k7_validity_dataset(spark, sf):
    published = codes(spark, sf).select("code_id", "code_name", F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("html"))
    return jobs.validity_dataset(published).select("code_id", "article_num", "label")


@query("k8_hierarchy_dataset", f"""with norms as ({NORMS_SQL}), lev as ({LEVEL_SQL}) select id as doc_id, concat_ws(' ', title, raw_text) as text, level as label from lev
 where level in (select level from lev group by level having count(*) >= 5)""")
def k8_hierarchy_dataset(spark, sf):
    return jobs.hierarchy_dataset(*_stored(spark, sf))


@query("o5_top_weights", f"""with {TFIDF_SQL}, good as (select doc_id from labels where quality = 1)
select term, round(sum(case when doc_id in (select doc_id from good) then weight else -weight end), 6) as weight from tfidf group by term order by sum(case when doc_id in (select doc_id from good) then weight else -weight end) desc, term limit 20""")
def o5_top_weights(spark, sf):
    """Top features of the centroid rule whose attribution is checked elsewhere."""
    weights = features.tfidf(wide_table(spark, sf, "documents"), "doc_id", "text", VOCAB)
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id", F.lit(1).alias("good"))
    sign = F.when(F.col("good") == 1, 1).otherwise(-1)
    sums = weights.join(good, "doc_id", "left").groupBy("term").agg(F.sum(sign * F.col("weight")).alias("weight"))
    return classify.top_features(sums, 20).withColumn("weight", F.round("weight", 6))
