"""Aggregates, sorting and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions.rules import label_article
from lexmill.operators import classify, dataset, ingest, profile
from lexmill.operators.extract import extract_articles, extract_citations, split_code_articles
from lexmill.plans.corpus import ARTICLES_SQL, CODE_BLOCKS_SQL, NORMS_SQL, codes, norms
from lexmill.plans.generators import CITATIONS_SQL, TITLE_WORDS_SQL
from lexmill.plans.joins import OUTCOMES_SQL, j5_outcomes, versions
from lexmill.plans.registry import query, table, wide_table


@query("a1_type_counts", f"with norms as ({NORMS_SQL}) select coalesce(nullif(type, 'LEY'), 'Sin tipo') as type, count(*) as n from norms group by all order by n desc, type limit 12")
def a1_type_counts(spark, sf):
    return profile.count_by(norms(spark, sf).withColumn("type", F.nullif(F.col("type"), F.lit("LEY"))), "type")


@query("a1_source_counts", "select coalesce(source, 'Sin tipo') as source, count(*) as n from documents group by all order by n desc, source limit 12")
def a1_source_counts(spark, sf):
    return profile.count_by(table(spark, sf, "documents"), "source")


@query("a2_year_counts", "select year(o_orderdate) as year, count(*) as n from orders group by 1")
def a2_year_counts(spark, sf):
    return profile.count_by_year(table(spark, sf, "orders"), "o_orderdate")


@query("a3_top_words", f"with norms as ({NORMS_SQL}) select word, count(*) as n from ({TITLE_WORDS_SQL}) group by word order by n desc, word limit 80")
def a3_top_words(spark, sf):
    return profile.top_words(norms(spark, sf), "title")


@query("a3_top_words_documents", """select word, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_][\\p{L}\\p{N}_'']*')) as word from documents)
 where word not in ('the', 'de') group by word order by n desc, word limit 80""")
def a3_top_words_documents(spark, sf):
    return profile.top_words(wide_table(spark, sf, "documents"), "text", stopwords=["the", "de"])


@query("a4_pivot", """select d.lang, count(*) filter (quality = 0) as "Derogado", count(*) filter (quality = 1) as "Vigente", count(*) as total from documents d join labels l on l.doc_id = d.doc_id group by d.lang""")
def a4_pivot(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id")
    return profile.label_pivot(joined, "lang", "quality")


@query("a5_shares", f"with norms as ({NORMS_SQL}), {CITATIONS_SQL} select citation_type, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct from citations group by citation_type")
def a5_shares(spark, sf):
    return profile.share_by(extract_citations(norms(spark, sf), "id", "raw_text"), "citation_type")


@query("a5_event_shares", "select event_type, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct from events group by event_type")
def a5_event_shares(spark, sf):
    return profile.share_by(table(spark, sf, "events"), "event_type")


@query("a6_summary", f"""with norms as ({NORMS_SQL}), {CITATIONS_SQL} select count(*) as norms, count(distinct type) as types, count(date) as dated, year(min(date)) as first_year, year(max(date)) as last_year,
 count(*) filter (is_valid = 1) as valid, count(*) filter (is_valid = 0) as invalid, count(*) filter (is_valid is null) as unknown, count(*) filter (nullif(id % 9, 0) is null) as null_titles,
 (select count(*) from citations) as citations from norms""")
def a6_summary(spark, sf):
    n = norms(spark, sf)
    return profile.corpus_summary(n.withColumn("title", F.when(F.col("id") % 9 != 0, F.col("title"))), extract_citations(n, "id", "raw_text"))


@query("a7_outcomes", f"with {OUTCOMES_SQL} select outcome, count(*) as n from outcomes group by outcome")
def a7_outcomes(spark, sf):
    return ingest.outcome_totals(j5_outcomes(spark, sf))


@query("a8_validation", f"""with norms as ({NORMS_SQL}), v as (select is_valid as o, case when id % 4 = 0 then 0 else 1 end as v, id % 10 = 3 as e from norms)
select count(*) filter (not e) as checked, count(*) filter (not e and v = 1) as valid, count(*) filter (not e and v = 0) as invalid, count(*) filter (e) as errors, count(*) filter (not e and o <> v) as changed from v""")
def a8_validation(spark, sf):
    n = norms(spark, sf).withColumn("now_valid", F.when(F.col("id") % 4 == 0, 0).otherwise(1)).withColumn("error", F.when(F.col("id") % 10 == 3, "x"))
    return ingest.validation_totals(n, "is_valid", "now_valid", "error")


@query("a9_checks", f"""with norms as ({NORMS_SQL}), arts as ({ARTICLES_SQL}), {CITATIONS_SQL}
select 'norms' as "check", count(*) as n from norms union all select 'articles', count(*) from arts union all select 'citations', count(*) from citations
union all select 'valid', count(*) from norms where is_valid = 1 union all select 'invalid', count(*) from norms where is_valid = 0 union all select 'unknown', count(*) from norms where is_valid is null""")
def a9_checks(spark, sf):
    n = norms(spark, sf)
    return profile.table_checks(n, extract_articles(n, "id", "raw_text"), extract_citations(n, "id", "raw_text"))


@query("a10_classes", "select quality, count(*) as n from labels group by quality")
def a10_classes(spark, sf):
    return dataset.class_counts(table(spark, sf, "labels"), "quality")


@query("a12_fold_stats", "with s as (select user_id, avg(value) as f1 from events group by user_id) select round(avg(f1), 6) as mean, round(stddev_pop(f1), 6) as std from s")
def a12_fold_stats(spark, sf):
    scores = table(spark, sf, "events").groupBy("user_id").agg(F.avg("value").alias("f1"))
    return classify.fold_stats(scores).select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("a13_per_code", f"with {CODE_BLOCKS_SQL} select code_name, count(*) as articles, count(*) filter (contains(block, '(*)')) as repealed from blocks group by code_name")
def a13_per_code(spark, sf):
    labelled = label_article(split_code_articles(codes(spark, sf), "code_id", "text", ["code_name"]))
    return profile.articles_per_code(labelled, "code_name")


# --- Sorting ------------------------------------------------------------------------

@query("o1_recent", f"with norms as ({NORMS_SQL}) select id, title from norms order by updated desc, id limit 500")
def o1_recent(spark, sf):
    return profile.recent(norms(spark, sf), "updated", "id", 500).select("id", "title")


@query("o1_recent_all", f"with norms as ({NORMS_SQL}) select id, title from norms")
def o1_recent_all(spark, sf):
    return profile.recent(norms(spark, sf), "updated", "id").select("id", "title")


@query("o2_newest", "select o_orderkey as id, o_custkey as norm_id from orders")
def o2_newest(spark, sf):
    return profile.newest_first(versions(spark, sf)).select("id", "norm_id")


@query("o3_cap", "select doc_id, n_chars from documents where length(text) between 1 and 5000 order by n_chars desc, doc_id limit 100")
def o3_cap(spark, sf):
    docs = ingest.keep_sized(table(spark, sf, "documents"), "text", 5000).withColumn("shortest", -F.col("n_chars"))
    return profile.cap(docs, ["shortest", "doc_id"], 100).select("doc_id", "n_chars")


@query("o4_page", "select doc_id, lang from documents order by doc_id limit 25 offset 50")
def o4_page(spark, sf):
    return profile.page(table(spark, sf, "documents"), ["doc_id"], 50, 75).select("doc_id", "lang")
