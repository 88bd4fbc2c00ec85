"""Row generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.functions.tokens import title_words
from lexmill.operators import extract, features
from lexmill.plans.corpus import ARTICLES_SQL, CODE_BLOCKS_SQL, NORMS_SQL, codes, norms
from lexmill.plans.registry import query, table, wide_table

_CUES = {k: " or ".join(f"contains(ctx, '{w}')" for w in ws) for k, ws in fixed.CITATION_CUES}


def _matches_sql(i: int, pattern: str, label: str) -> str:
    return f"""select id, {i} as p, '{label}' as source_type, raw_text,
  string_split(regexp_replace(raw_text, '{pattern}', chr(1) || '\\0' || chr(2), 'gi'), chr(1)) as pieces from norms"""


CITATIONS_SQL = f"""pieces as ({' union all '.join(_matches_sql(i, p, s) for i, (p, s) in enumerate(fixed.CITATION_PATTERNS))}),
found as (select id, p, i, source_type, trim(regexp_replace(split_part(pieces[i + 1], chr(2), 1), '\\s+', ' ', 'g')) as target_text, raw_text,
   cast(list_sum(list_transform(pieces[1:i], lambda x: length(replace(x, chr(2), '')))) as bigint) as before
   from pieces, unnest(range(1, len(pieces))) t(i)),
typed as (select *, lower(substr(raw_text, greatest(1, before - 49), least(50, before))) as ctx from found),
kept as (select *, row_number() over (partition by id, target_text order by p, i) as rn from typed),
citations as (select id, target_text, source_type, row_number() over (partition by id order by p, i) as "order",
   case when {_CUES['repeals']} then 'repeals' when {_CUES['modifies']} then 'modifies' when {_CUES['repealed_by']} then 'repealed_by' else 'refers' end as citation_type
   from kept where rn = 1)"""


@query("t1_articles", f"""with norms as ({NORMS_SQL}), arts as ({ARTICLES_SQL}) select id, cast("order" as varchar) as number, content, "order" from arts""")
def t1_articles(spark, sf):
    return extract.extract_articles(norms(spark, sf), "id", "raw_text")


@query("t1_articles_html", f"""with norms as ({NORMS_SQL}), arts as ({ARTICLES_SQL}) select id, count(*) as n, max("order") as last, sha256(string_agg(content, '|' order by "order")) as digest from arts group by id""")
def t1_articles_html(spark, sf):
    """The same texts published as HTML, one paragraph per line, accents as entities."""
    lines = F.regexp_replace(F.replace("raw_text", F.lit("í"), F.lit("&iacute;")), "\n", "</p>\n<!-- x --><p class='a>b'>")
    pages = norms(spark, sf).select("id", F.concat(F.lit("<html><style>p{}</style><body><p>"), lines, F.lit("</p></body></html>")).alias("html"))
    arts = extract.extract_articles(pages, "id", "html")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("order", "content"))), lambda x: x["content"]), "|")
    return arts.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("order").alias("last"), F.sha2(joined, 256).alias("digest"))


@query("t2_citations", f"with norms as ({NORMS_SQL}), {CITATIONS_SQL} select * from citations")
def t2_citations(spark, sf):
    return extract.extract_citations(norms(spark, sf), "id", "raw_text")


@query("t3_code_articles", f"with {CODE_BLOCKS_SQL} select code_id, code_name, article_num, block from blocks")
def t3_code_articles(spark, sf):
    return extract.split_code_articles(codes(spark, sf), "code_id", "text", ["code_name"]).drop("pos")


@query("t4_caps", """select conv_id, i as "order", left(string_split(text, ' ')[i], 5) as word from conversations, turns_of, unnest(range(1, 13)) t(i) where i <= len(string_split(text, ' '))""".replace(", turns_of", ""))
def t4_caps(spark, sf):
    """At most twelve words of a message, five characters each."""
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("word")))
    rows = table(spark, sf, "conversations").select("conv_id", words.alias("words"))
    return extract.cap_children(rows, "conv_id", "words", 12, "word", 5)


@query("t4_capped_norms", f"""with norms as ({NORMS_SQL}), {CITATIONS_SQL} select id, left(target_text, 9) as target_text, citation_type, source_type, "order" from citations where "order" <= 3""")
def t4_capped_norms(spark, sf):
    return extract.extract_citations(norms(spark, sf), "id", "raw_text", max_citations=3, max_chars=9)


@query("t5_tokens", "select doc_id, term, count(*) as n from (select doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) as term from documents) where term <> '' group by all")
def t5_tokens(spark, sf):
    return extract.explode_tokens(wide_table(spark, sf, "documents"), "doc_id", "text").groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


_WORDS = "select {id}, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') as w from {t}"
GRAMS_SQL = """select {id}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as term from ({words})"""


def grams_sql(t: str, id: str) -> str:
    return GRAMS_SQL.replace("{words}", _WORDS).replace("{id}", id).replace("{t}", t)


@query("t6_ngrams", f"select doc_id, term, count(*) as n from ({grams_sql('documents', 'doc_id')}) group by all")
def t6_ngrams(spark, sf):
    return features.ngram_counts(wide_table(spark, sf, "documents"), "doc_id", "text")


STOP_SQL = ", ".join(f"'{w}'" for w in fixed.TITLE_STOPWORDS)
TITLE_WORDS_SQL = f"""select id, word from (select id, unnest(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_'']*')) as word from norms) where word not in ({STOP_SQL})"""


@query("t7_title_words", f"with norms as ({NORMS_SQL}) select id, word from ({TITLE_WORDS_SQL})")
def t7_title_words(spark, sf):
    return norms(spark, sf).select("id", F.explode(title_words("title")).alias("word"))
