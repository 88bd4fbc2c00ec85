"""Retrieval and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.operators import irmetrics, retrieval
from lexmill.plans.corpus import NORMS_SQL, norms
from lexmill.plans.registry import ORACLE, query, table, wide_table
from lexmill.session import scratch_path, stage
from lexmill.sources import postings, vectors

# --- Text search: benchmark texts against documents -------------------------------


def bm25_sql(docs: str, id: str, text: str, queries: str, qid: str, qtext: str, k: int, keep: str = "") -> str:
    k1, b, eps = fixed.BM25_K1, fixed.BM25_B, fixed.BM25_EPSILON
    tok = lambda c: f"list_filter(regexp_split_to_array(lower({c}), '\\s+'), lambda x: x <> '')"
    return f"""bm_docs as (select {id} as doc_id, {tok(text)} as toks from {docs}),
bm_post as (select doc_id, term, count(*) as tf, any_value(dl) as dl from (select doc_id, len(toks) as dl, unnest(toks) as term from bm_docs) group by doc_id, term),
bm_stat as (select count(*) as n, avg(len(toks)) as avgdl from bm_docs),
bm_raw as (select term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) as r, count(*) as df from bm_post, bm_stat group by term, n),
bm_mean as (select avg(r) as mean_idf, count(*) as n_terms from bm_raw),
bm_idf as (select term, df, case when r < 0 then {eps} * mean_idf else r end as idf from bm_raw, bm_mean),
bm_q as (select query_id, term, count(*) as qtf from (select {qid} as query_id, unnest({tok(qtext)}) as term from {queries}) group by all),
bm_score as (select query_id, doc_id, round(sum(qtf * idf * tf * ({k1} + 1) / (tf + {k1} * (1 - {b} + {b} * dl / avgdl))), 9) as score
  from bm_q join bm_idf using (term) join bm_post using (term), bm_stat group by query_id, doc_id),
bm25 as (select * from (select query_id, doc_id, score, row_number() over (partition by query_id order by score desc, doc_id) as rank from bm_score where score > 0 {keep}) where rank <= {k})"""


_BM25 = bm25_sql("documents", "doc_id", "text", "benchmark", "item_id", "text", 5)


def _queries(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _bm25(spark, sf, k=5, keep=None):
    index = retrieval.bm25_index(wide_table(spark, sf, "documents"), "doc_id", "text")
    return retrieval.bm25_topk(_queries(spark, sf), index, k, keep=keep)


def _rounded(hits):
    return hits.withColumn("score", F.round("score", 6))


@query("r4_bm25_stats", f"with {_BM25} select n, round(avgdl, 6) as avgdl, round(mean_idf, 6) as mean_idf, n_terms from bm_stat, bm_mean")
def r4_bm25_stats(spark, sf):
    stats = retrieval.bm25_index(wide_table(spark, sf, "documents"), "doc_id", "text").stats
    return stats.select("n", F.round("avgdl", 6).alias("avgdl"), F.round("mean_idf", 6).alias("mean_idf"), "n_terms")


_TERMS_SQL = f"""t as materialized (select list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') as toks from documents),
d as materialized (select term, count(*) as df from (select unnest(list_distinct(toks)) as term from t) group by term),
r as materialized (select term, df, ln(n - df + 0.5) - ln(df + 0.5) as r from d, (select count(*) as n from t))"""


@query("r4_bm25_terms", f"with {_TERMS_SQL} select term, df, round(case when r < 0 then {fixed.BM25_EPSILON} * m else r end, 6) as idf from r, (select avg(r) as m from r)")
def r4_bm25_terms(spark, sf):
    terms = retrieval.bm25_index(wide_table(spark, sf, "documents"), "doc_id", "text").terms
    return terms.select("term", "df", F.round("idf", 6).alias("idf"))


@query("r5_bm25", f"with {_BM25} select query_id, doc_id, round(score, 6) as score, rank from bm25")
def r5_bm25(spark, sf):
    return _rounded(_bm25(spark, sf))


def _stored(spark, sf, keep=None):
    path = scratch_path(spark, "bm25")
    postings.write_bm25(wide_table(spark, sf, "documents"), "doc_id", "text", path)
    return postings.search_stored(_queries(spark, sf), postings.load_bm25(spark, path), 5, keep=keep)


@query("r5_bm25_stored", ORACLE["r5_bm25"])
def r5_bm25_stored(spark, sf):
    """The same hits from an index that is stored and read back, of which only blocks that can enter the first five are scored."""
    return _rounded(_stored(spark, sf).hits)


_KEEP = "and doc_id in (select doc_id from labels where quality = 1)"


@query("r5_bm25_valid", f"with {bm25_sql('documents', 'doc_id', 'text', 'benchmark', 'item_id', 'text', 5, _KEEP)} select query_id, doc_id, round(score, 6) as score, rank from bm25")
def r5_bm25_valid(spark, sf):
    return _rounded(_bm25(spark, sf, keep=table(spark, sf, "labels").where("quality = 1")))


@query("r5_bm25_stored_valid", ORACLE["r5_bm25_valid"])
def r5_bm25_stored_valid(spark, sf):
    return _rounded(_stored(spark, sf, keep=table(spark, sf, "labels").where("quality = 1")).hits)


@query("f7_positive", f"with {_BM25} select query_id, count(*) as n from bm_score where score > 0 group by query_id")
def f7_positive(spark, sf):
    """How many documents score above zero for each query: the size of the full ranking, before any cut."""
    index = retrieval.bm25_index(wide_table(spark, sf, "documents"), "doc_id", "text")
    out = None
    for scored in retrieval.bm25_scores(_queries(spark, sf), index):
        counts = retrieval.positive(scored).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
        out = counts if out is None else out.unionByName(counts)
    return out


@query("j8_terms", f"with {_BM25} select query_id, count(*) as matches, sum(tf)::bigint as occurrences from bm_q join bm_post using (term) group by query_id")
def j8_terms(spark, sf):
    postings = retrieval.bm25_postings(retrieval.counted_documents(wide_table(spark, sf, "documents"), "doc_id", "text"))
    weights = retrieval.query_terms(_queries(spark, sf), "query_id", "query")
    blocks = [m.groupBy("query_id").agg(F.count(F.lit(1)).alias("matches"), F.sum("tf").alias("occurrences")) for m in retrieval.match_terms(weights, postings)]
    out = blocks[0]
    for more in blocks[1:]:
        out = out.unionByName(more)
    return out


# --- Titles of the norm corpus against the fixed evaluation set ----------------------

_QSET_SQL = "eval as (select * from (values " + ", ".join(
    f"({i}, '{q}', [{', '.join(chr(39) + w + chr(39) for w in kw)}])" for i, (q, kw) in enumerate(fixed.EVALUATION_QUERIES, 1)
) + ") t(query_id, query, keywords))"
_NORM_BM25 = f"norms as ({NORMS_SQL}), {_QSET_SQL}, " + bm25_sql("norms", "id", "title", "eval", "query_id", "query", 5, "and doc_id in (select id from norms where is_valid = 1)")


def _norm_hits(spark, sf, k=5):
    n = norms(spark, sf)
    index = retrieval.bm25_index(n, "id", "title")
    keep = n.where("is_valid = 1").select(F.col("id").alias("doc_id"))
    return retrieval.bm25_topk(irmetrics.evaluation_queries(spark), index, k, keep=keep)


@query("p21_listing", f"""with {_NORM_BM25} select b.query_id, b.rank, case when n.is_valid = 1 then 'VIGENTE' else 'DEROGADA' end as tag, concat(n.type, ' ', n.number) as norm,
 printf('%.4f', b.score) as score_text, left(n.title, 90) as title, n.url from bm25 b join norms n on n.id = b.doc_id""")
def p21_listing(spark, sf):
    meta = norms(spark, sf).select(F.col("id").alias("doc_id"), "type", "number", "title", "url", "is_valid")
    return retrieval.format_hits(_norm_hits(spark, sf).join(meta, "doc_id"))


# --- Dense search -------------------------------------------------------------------

_CENTROIDS = """dims as (select vec_id, label, generate_subscripts(embedding, 1) as i, unnest(embedding)::double as x from embeddings),
sums as (select label, i, sum(x) as x from dims group by label, i),
cent as (select label as query_id, list(x / nrm order by i) as qv from (select label, i, x, sqrt(sum(x * x) over (partition by label)) as nrm from sums) group by label),
allscore as (select c.query_id, e.vec_id as doc_id, e.label, round(list_sum(list_transform(list_zip(c.qv, e.embedding), lambda p: p[1] * p[2]::double)), 9) as score from cent c, embeddings e)"""


def _ranked_sql(source: str, k: int) -> str:
    return f"(select query_id, doc_id, label, score, row_number() over (partition by query_id order by score desc, doc_id) as rank from {source} qualify rank <= {k})"


def _centroids(spark, sf):
    """One query vector per label: the unit mean of its vectors."""
    dims = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    sums = dims.groupBy("label", "i").agg(F.sum(F.col("x").cast("double")).alias("x"))
    packed = sums.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("p"))
    v = F.transform("p", lambda s: s["x"])
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return packed.select(F.col("label").alias("query_id"), F.transform(v, lambda x: x / norm).alias("embedding"))


@query("r2_dense", f"with {_CENTROIDS} select query_id, doc_id, round(score, 6) as score, rank from {_ranked_sql('allscore', 5)}")
def r2_dense(spark, sf):
    return _rounded(retrieval.dense_topk(_centroids(spark, sf), table(spark, sf, "embeddings"), 5, doc_id="vec_id"))


@query("r2_dense_blocks", f"with {_CENTROIDS} select query_id, doc_id, round(score, 6) as score, rank from {_ranked_sql('allscore', 5)}")
def r2_dense_blocks(spark, sf):
    """The same search by the way for query sets too large for one matrix."""
    hits = retrieval.dense_topk(_centroids(spark, sf), table(spark, sf, "embeddings"), 5, doc_id="vec_id", max_queries=3)
    return _rounded(hits)


@query("r3_dense_post", f"""with {_CENTROIDS}, c as (select * from {_ranked_sql('allscore', 50)}), f as (select query_id, doc_id, label, score from c where label % 2 = 0)
select query_id, doc_id, round(score, 6) as score, rank from {_ranked_sql('f', 5)}""")
def r3_dense_post(spark, sf):
    return _rounded(retrieval.dense_topk(_centroids(spark, sf), table(spark, sf, "embeddings"), 5, "post", F.col("label") % 2 == 0, doc_id="vec_id"))


@query("r3_dense_pre", f"""with {_CENTROIDS}, f as (select * from allscore where label % 2 = 0) select query_id, doc_id, round(score, 6) as score, rank from {_ranked_sql('f', 5)}""")
def r3_dense_pre(spark, sf):
    return _rounded(retrieval.dense_topk(_centroids(spark, sf), table(spark, sf, "embeddings"), 5, "pre", F.col("label") % 2 == 0, doc_id="vec_id"))


def _clustered(spark, sf, keep=None):
    path = scratch_path(spark, "vectors")
    vectors.write_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", path)
    return vectors.search_vectors(_centroids(spark, sf), vectors.load_vectors(spark, path), 5, keep, doc_id="vec_id")


@query("r2_dense_stored", ORACLE["r2_dense"])
def r2_dense_stored(spark, sf):
    """The same hits from an index that is stored by cluster, of which only clusters that can enter the first five are read."""
    return _rounded(_clustered(spark, sf).hits)


@query("r3_dense_stored", ORACLE["r3_dense_pre"])
def r3_dense_stored(spark, sf):
    return _rounded(_clustered(spark, sf, F.col("label") % 2 == 0).hits)


@query("s11_clusters", "select label, count(*) as n, sum(vec_id)::bigint as ids from embeddings where embedding is not null group by label")
def s11_clusters(spark, sf):
    """What a stored index holds, read back by label."""
    path = scratch_path(spark, "vectors")
    vectors.write_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", path)
    return vectors.load_vectors(spark, path).vectors.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("vec_id").alias("ids"))


@query("w6_topk", f"with {_CENTROIDS} select query_id as label, doc_id, round(score, 6) as score, rank from {_ranked_sql('(select * from allscore where label = query_id)', 7)}")
def w6_topk(spark, sf):
    """The seven vectors of each label nearest to its centre, ranked by a plain window."""
    cent = _centroids(spark, sf).select(F.col("query_id").alias("label"), F.col("embedding").alias("qv"))
    scored = table(spark, sf, "embeddings").join(cent, "label")
    dot = F.aggregate(F.zip_with("qv", F.col("embedding"), lambda a, b: a * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    rows = scored.select("label", F.col("vec_id").alias("doc_id"), F.round(dot, 9).alias("score"))
    return _rounded(retrieval.rank_topk(rows, "label", "score", "doc_id", 7)).select("label", "doc_id", "score", "rank")


DIM = 64


def _hashed_sql(name: str, source: str, id: str, text: str) -> str:
    return f"""{name}_c as (select id, d, count(*)::double as c from (select {id} as id, ('0x' || substr(md5(term), 1, 8))::ubigint % {DIM} as d
  from (select {id}, unnest(list_filter(regexp_split_to_array(lower({text}), '\\s+'), lambda x: x <> '')) as term from {source})) group by all),
{name} as (select id, d, cast(c / sqrt(sum(c * c) over (partition by id)) as float)::double as x from {name}_c)"""


@query("r1_encode", f"with {_hashed_sql('e', 'documents', 'doc_id', 'text')} select doc_id, count(x) as filled, round(coalesce(max(x), 0), 5) as largest, round(coalesce(sum(x * (d + 1)), 0), 3) as mixed from documents left join e on id = doc_id group by doc_id")
def r1_encode(spark, sf):
    vectors = retrieval.encode(wide_table(spark, sf, "documents").select("doc_id", "text"), "text", retrieval.hashed_terms_encoder(DIM))
    x = F.col("embedding").cast("array<double>")
    filled = F.size(F.filter(x, lambda v: v != 0)).cast("long")
    mixed = F.aggregate(F.transform(x, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return vectors.select("doc_id", filled.alias("filled"), F.round(F.array_max(x), 5).alias("largest"), F.round(mixed, 3).alias("mixed"))


_DENSE_TEXT = f"""{_hashed_sql('e', 'documents', 'doc_id', 'text')}, {_hashed_sql('q', 'benchmark', 'item_id', 'text')},
ds as (select q.id as query_id, e.id as doc_id, round(sum(q.x * e.x), 9) as score, 0 as label from q join e using (d) group by q.id, e.id)"""


def _dense_text(spark, sf, k=5):
    encoder = retrieval.hashed_terms_encoder(DIM)
    index = retrieval.encode(wide_table(spark, sf, "documents").select("doc_id", "text"), "text", encoder)
    queries = retrieval.encode(_queries(spark, sf), "query", encoder)
    return retrieval.dense_topk(queries, index, k)


@query("j7_dense_text", f"with {_DENSE_TEXT} select query_id, doc_id, round(score, 5) as score, rank from {_ranked_sql('ds', 5)}")
def j7_dense_text(spark, sf):
    return _dense_text(spark, sf).withColumn("score", F.round("score", 5))


@query("j11_side_by_side", f"""with {_DENSE_TEXT}, {_BM25}, a as (select * from {_ranked_sql('ds', 5)})
select coalesce(a.query_id, b.query_id) as query_id, coalesce(a.rank, b.rank) as rank, a.doc_id as dense_doc, round(a.score, 5) as dense_score, b.doc_id as lexical_doc, round(b.score, 5) as lexical_score
from a full join bm25 b on a.query_id = b.query_id and a.rank = b.rank""")
def j11_side_by_side(spark, sf):
    both = retrieval.side_by_side(_dense_text(spark, sf), _bm25(spark, sf))
    return both.withColumns({"dense_score": F.round("dense_score", 5), "lexical_score": F.round("lexical_score", 5)})


# --- Metrics ------------------------------------------------------------------------

# Judgements: the longer words of a benchmark text, looked for in whole documents.
_KW_SQL = "kw as (select item_id as query_id, list_distinct(list_filter(string_split(lower(text), ' '), lambda w: length(w) > 9)) as keywords from benchmark)"


def metrics_sql(docs: str, id: str, title: str, kind: str) -> str:
    """Metrics per system and query from ds (dense scores), bm25 and kw (query_id, keywords) over titles and types of `docs`."""
    return f"""hits as (select 'dense' as system, query_id, doc_id, rank from {_ranked_sql('ds', 5)} union all select 'bm25', query_id, doc_id, rank from bm25),
judged as (select h.*, d.{title} as title, kw.keywords, len(list_filter(kw.keywords, lambda w: contains(lower(d.{title}) || ' ' || lower(d.{kind}), lower(w)))) > 0 as rel
  from hits h join {docs} d on d.{id} = h.doc_id join kw on kw.query_id = h.query_id),
grid as (select query_id, system from kw, (values ('dense'), ('bm25')) s(system)),
met as (select system, query_id, count(*) filter (rel) / 5.0 as precision, coalesce(1.0 / min(rank) filter (rel), 0) as mrr,
  coalesce(sum(1.0 / log2(rank + 1)) filter (rel), 0) as dcg, count(*) filter (rel) as nrel from judged group by system, query_id),
found as (select system, query_id, count(distinct w) as f from (select system, query_id, title, unnest(keywords) as w from judged) where contains(lower(title), lower(w)) group by system, query_id),
metrics as (select g.system, g.query_id, coalesce(m.precision, 0) as precision, coalesce(m.mrr, 0) as mrr,
  coalesce(m.dcg / nullif(list_sum(list_transform(range(1, m.nrel + 1), lambda i: 1.0 / log2(i + 1))), 0), 0) as ndcg,
  case when len(kw.keywords) > 0 then coalesce(f.f, 0) / len(kw.keywords) else 0 end as keyword_recall
  from grid g left join met m on m.system = g.system and m.query_id = g.query_id left join found f on f.system = g.system and f.query_id = g.query_id join kw on kw.query_id = g.query_id)"""


_JUDGED = f"{_DENSE_TEXT}, {_BM25}, {_KW_SQL}, {metrics_sql('documents', 'doc_id', 'text', 'lang')}"


def _judgements(spark, sf):
    words = F.array_distinct(F.filter(F.split(F.lower("text"), " "), lambda w: F.length(w) > 9))
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), words.alias("keywords"))


def _systems(spark, sf):
    meta = wide_table(spark, sf, "documents").select("doc_id", F.col("text").alias("title"), F.col("lang").alias("type"))
    # Hits are few and staged, so Spark sees their size and sends them to the texts.
    return {name: stage(hits, "hits").join(meta, "doc_id") for name, hits in (("dense", _dense_text(spark, sf)), ("bm25", _bm25(spark, sf)))}


def _judged(spark, sf):
    systems = _systems(spark, sf)
    hits = None
    for name, df in systems.items():
        part = df.withColumn("system", F.lit(name))
        hits = part if hits is None else hits.unionByName(part)
    return irmetrics.judge(hits, _judgements(spark, sf))


@query("j9_judge", f"with {_JUDGED} select system, query_id, doc_id, rank, rel::int as rel from judged")
def j9_judge(spark, sf):
    return _judged(spark, sf).select("system", "query_id", "doc_id", "rank", "rel")


NAMES = ["dense", "bm25"]


@query("r6_precision", f"with {_JUDGED} select system, query_id, round(precision, 6) as precision from metrics")
def r6_precision(spark, sf):
    out = irmetrics.precision_at_k(_judged(spark, sf), _judgements(spark, sf), 5, NAMES)
    return out.withColumn("precision", F.round("precision", 6))


@query("r7_keyword_recall", f"with {_JUDGED} select system, query_id, round(keyword_recall, 6) as keyword_recall from metrics")
def r7_keyword_recall(spark, sf):
    out = irmetrics.keyword_recall_at_k(_judged(spark, sf), _judgements(spark, sf), 5, NAMES)
    return out.withColumn("keyword_recall", F.round("keyword_recall", 6))


@query("r8_mrr", f"with {_JUDGED} select system, query_id, round(mrr, 6) as mrr from metrics")
def r8_mrr(spark, sf):
    return irmetrics.mrr_at_k(_judged(spark, sf), _judgements(spark, sf), 5, NAMES).withColumn("mrr", F.round("mrr", 6))


@query("r9_ndcg", f"with {_JUDGED} select system, query_id, round(ndcg, 6) as ndcg from metrics")
def r9_ndcg(spark, sf):
    return irmetrics.ndcg_at_k(_judged(spark, sf), _judgements(spark, sf), 5, NAMES).withColumn("ndcg", F.round("ndcg", 6))


@query("r10_evaluate", f"""with {_JUDGED} select system, query_id, round(precision, 6) as precision, round(mrr, 6) as mrr, round(ndcg, 6) as ndcg, round(keyword_recall, 6) as keyword_recall from metrics""")
def r10_evaluate(spark, sf):
    out = irmetrics.evaluate(_judgements(spark, sf), _systems(spark, sf), 5)
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "mrr", "ndcg", "keyword_recall")})


_MEAN = " union all ".join(
    f"select '{m}' as metric, round(avg({m}) filter (system = 'dense'), 6) as dense, round(avg({m}) filter (system = 'bm25'), 6) as bm25, round(avg({m}) filter (system = 'dense') - avg({m}) filter (system = 'bm25'), 6) as gain from metrics"
    for m in ("precision", "keyword_recall", "mrr", "ndcg"))


@query("a11_mean_metrics", f"with {_JUDGED} {_MEAN}")
def a11_mean_metrics(spark, sf):
    metrics = irmetrics.evaluate(_judgements(spark, sf), _systems(spark, sf), 5)
    out = irmetrics.mean_metrics(metrics, "dense", "bm25")
    return out.withColumns({c: F.round(c, 6) for c in ("dense", "bm25", "gain")})
