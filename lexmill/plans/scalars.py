"""Projections, scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.functions import html, rules, text
from lexmill.operators import ingest
from lexmill.operators.extract import min_length
from lexmill.plans.corpus import CODE_BLOCKS_SQL, NORMS_SQL, norms
from lexmill.plans.registry import query, table, wide_table

WS = "' ' || chr(9) || chr(10) || chr(13)"


def _plain_html_sql(sep: str) -> str:
    cleaned = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', chr(1), 'g'),
      '(?is)<script\\b[^>]*>.*?</script\\s*>', chr(1), 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', chr(1), 'g'), '<[!?/A-Za-z][^>]*>', chr(1), 'g')"""
    decoded = "replace(replace(replace(replace(x, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"
    return f"array_to_string(list_filter(list_transform(string_split({cleaned}, chr(1)), lambda x: trim({decoded}, {WS})), lambda x: x <> ''), {sep})"


@query("p1_html_lines", f"select page_id, {_plain_html_sql('chr(10)')} as text from pages")
def p1_html_lines(spark, sf):
    return wide_table(spark, sf, "pages").select("page_id", html.html_to_text("html", "\n").alias("text"))


@query("p1_html_spaces", f"select page_id, {_plain_html_sql(chr(39) + ' ' + chr(39))} as text from pages")
def p1_html_spaces(spark, sf):
    return wide_table(spark, sf, "pages").select("page_id", html.html_to_text("html", " ", always=True).alias("text"))


@query("p2_squash", f"select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as text from documents")
def p2_squash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.squash("text").alias("text"))


@query("p3_fold", "select doc_id, strip_accents(lower(text)) as text from documents")
def p3_fold(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", text.fold("text").alias("text"))


def _level_case(c: str) -> str:
    return " ".join(
        f"when {' or '.join(f'contains({c}, {chr(39)}{w}{chr(39)})' for w in words)} then {level}" for level, words in fixed.LEVEL_KEYWORDS)


LEVEL_SQL = f"""select *, case {_level_case('k')} {_level_case('b')} else 5 end as level from
 (select *, strip_accents(lower(coalesce(type, ''))) as k, strip_accents(lower(concat(coalesce(type, ''), ' ', coalesce(title, '')))) as b from norms)"""


@query("p4_level", f"with norms as ({NORMS_SQL}), l as ({LEVEL_SQL}) select id, type, title, level from l")
def p4_level(spark, sf):
    return rules.with_level(norms(spark, sf)).select("id", "type", "title", "level")


@query("p5_truncate", "select doc_id, left(text, 1000) as text, left(source, 4) as source, (length(text) > 1000)::int + (length(source) > 4)::int as cut_fields from documents")
def p5_truncate(spark, sf):
    return ingest.truncate_fields(table(spark, sf, "documents"), {"text": 1000, "source": 4}).select("doc_id", "text", "source", "cut_fields")


@query("p5_cut_totals", "select sum((length(text) > 1000)::int + (length(source) > 4)::int)::bigint as cut_fields, count(*) as n from documents")
def p5_cut_totals(spark, sf):
    cut = ingest.truncate_fields(table(spark, sf, "documents"), {"text": 1000, "source": 4})
    return cut.agg(F.sum("cut_fields").alias("cut_fields"), F.count(F.lit(1)).alias("n"))


@query("p6_hash", "select doc_id, sha256(coalesce(text, '')) as text_hash from documents")
def p6_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.content_hash("text").alias("text_hash"))


@query("p7_urls", """select page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') as tail, concat('https://example.org/#/detallenorma/', page_id) as detail from pages""")
def p7_urls(spark, sf):
    return wide_table(spark, sf, "pages").select("page_id", text.url_tail("url").alias("tail"), text.detail_url("page_id").alias("detail"))


@query("p8_titles", f"""with norms as ({NORMS_SQL}) select id, case id % 4 when 0 then title when 1 then concat('R ', title) when 2 then number else cast(id as varchar) end as picked from norms""")
def p8_titles(spark, sf):
    n, k = norms(spark, sf), F.col("id") % 4
    own = F.when(k == 0, F.col("title")).when(k == 1, fixed.TITLE_PLACEHOLDER).when(k == 2, "")
    summary = F.when(k == 1, F.concat(F.lit("R "), F.col("title"))).otherwise("")
    number = F.when(k == 2, F.col("number"))
    return n.select("id", text.pick_title(own, summary, number, F.col("id"), fixed.TITLE_PLACEHOLDER).alias("picked"))


_RAW_DATE = "case o_orderkey % 3 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then '2024-02-30' else 'nope' end"


@query("p9_dates", f"select o_orderkey, try_cast({_RAW_DATE} as date) as date, year(try_cast({_RAW_DATE} as date)) as year from orders")
def p9_dates(spark, sf):
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, "2024-02-30").otherwise("nope")
    return table(spark, sf, "orders").select("o_orderkey", text.safe_date(raw).alias("date"), text.year_of(text.safe_date(raw)).cast("long").alias("year"))


_P10_SQL = f"""with norms as ({NORMS_SQL}) select id, concat_ws('. ', type, concat('N° ', number), nullif(title, ''),
 nullif(CUT(trim(regexp_replace(raw_text, '\\s+', ' ', 'g'))), '')) as text from norms"""


def _p10(spark, sf, n):
    clean = text.squash(html.html_to_text("raw_text", " "))
    return norms(spark, sf).select("id", text.embedding_text(F.col("type"), F.col("number"), F.col("title"), clean, n).alias("text"))


@query("p10_embedding_text", _P10_SQL.replace("CUT", ""))
def p10_embedding_text(spark, sf):
    return _p10(spark, sf, None)


@query("p10_embedding_text_cut", _P10_SQL.replace("CUT(", "left(").replace("'g'))), '')", "'g')), 100), '')"))
def p10_embedding_text_cut(spark, sf):
    return _p10(spark, sf, 100)


@query("p11_classifier_text", """select doc_id, concat_ws(' ', nullif(source, ''), nullif(text, '')) as text, concat_ws(' ', nullif(lang, ''), nullif(source, ''), nullif(text, '')) as older from documents""")
def p11_classifier_text(spark, sf):
    c = F.col
    return table(spark, sf, "documents").select(
        "doc_id", text.classifier_text(c("source"), c("text")).alias("text"),
        text.classifier_text(c("source"), c("text"), kind=c("lang")).alias("older"))


@query("p11_classifier_text_cut", """select doc_id, concat_ws(' ', nullif(source, ''), nullif(left(text, 2500), '')) as text, concat_ws(' ', nullif(lang, ''), nullif(source, ''), nullif(left(text, 2000), '')) as older from documents""")
def p11_classifier_text_cut(spark, sf):
    c = F.col
    return table(spark, sf, "documents").select(
        "doc_id", text.classifier_text(c("source"), c("text"), 2500).alias("text"),
        text.classifier_text(c("source"), c("text"), 2000, kind=c("lang")).alias("older"))


@query("p12_snapshot", """select event_id, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' as snapshot, cast(json_extract(props, '$.k') as bigint) as k from events""")
def p12_snapshot(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", text.snapshot("event_type", "user_id").alias("snapshot"), F.from_json("props", "k long")["k"].alias("k"))


@query("p13_display", f"""with norms as ({NORMS_SQL}) select id, trim(concat(type, ' ', number)) as norm, concat(left(sha256(raw_text), 10), '...') as hash,
 strftime(date, '%Y-%m-%d') as day, strftime(updated, '%Y-%m-%dT%H:%M:%S') as moment from norms""")
def p13_display(spark, sf):
    return norms(spark, sf).select(
        "id", text.type_and_number("type", "number").alias("norm"), text.short_hash(text.content_hash("raw_text")).alias("hash"),
        text.iso_date("date").alias("day"), text.iso_time("updated").alias("moment"))


@query("p14_labels", "select doc_id, case quality when 1 then 'Vigente' else 'Derogado' end as quality_name, case toxic when 1 then 'si' else '0' end as toxic_name from labels")
def p14_labels(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id", text.relabel("quality", fixed.VALIDITY_NAMES).alias("quality_name"), text.relabel("toxic", {1: "si"}).alias("toxic_name"))


@query("p14_code_names", """select p_partkey, left(array_to_string(list_transform(string_split(lower(replace(concat('CODIGO ', p_name), 'CODIGO', 'C.')), ' '),
 lambda w: upper(left(w, 1)) || substr(w, 2)), ' '), 26) as code from part""")
def p14_code_names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.short_code_name(F.concat(F.lit("CODIGO "), F.col("p_name"))).alias("code"))


@query("p15_fill", """select d.doc_id, coalesce(case when d.lang = 'en' then null else d.lang end, 'Sin tipo') as lang, coalesce(l.quality, 5) as quality from documents d left join labels l on l.doc_id = d.doc_id""")
def p15_fill(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.nullif(F.col("lang"), F.lit("en")).alias("lang"))
    joined = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return ingest.fill(joined, {"lang": fixed.TYPE_MISSING, "quality": fixed.LEVEL_DEFAULT})


@query("p16_features", f"with norms as ({NORMS_SQL}) select id, (contains(lower(raw_text), 'derog') or contains(lower(raw_text), 'sin efecto'))::int as has_derogation, length(raw_text) as text_length from norms")
def p16_features(spark, sf):
    return norms(spark, sf).select("id", text.mentions_repeal("raw_text").alias("has_derogation"), F.length("raw_text").cast("long").alias("text_length"))


_MARK_SQL = """case id % 10 when 0 then concat('DEROGADA: ', substr(raw_text, strpos(raw_text, '(*) DEROGADO'), 200))
 when 1 then concat('SIN EFECTO: ', substr(raw_text, strpos(raw_text, '(*)  DEJADA'), 200)) end"""
_MARK_WHOLE_SQL = _MARK_SQL.replace(", 200)", ")")


@query("p17_marker", f"with norms as ({NORMS_SQL}), s as (select id, {_MARK_SQL} as status from norms) select id, status, case when status is not null then false end as is_valid from s")
def p17_marker(spark, sf):
    return norms(spark, sf).select("id", rules.marker_status("raw_text", fixed.MARKER_REASON_CHARS).alias("s")).select("id", "s.status", "s.is_valid")


@query("p17_marker_whole", f"with norms as ({NORMS_SQL}), s as (select id, {_MARK_WHOLE_SQL} as status from norms) select id, status, case when status is not null then false end as is_valid from s")
def p17_marker_whole(spark, sf):
    return norms(spark, sf).select("id", rules.marker_status("raw_text").alias("s")).select("id", "s.status", "s.is_valid")


_BANNER_SQL = """select page_id, regexp_extract(html, '(?is)<div class="ad">([^<]*)</div>', 1) as ad from pages"""
_PHRASES = ["nicht", "the ", "que", " la "]


_BANNER_STATUS_SQL = f"""with a as ({_BANNER_SQL}), d as (select page_id, trim(replace(replace(replace(replace(ad, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&')) as ad from a)
select page_id, case when {' or '.join(f"contains(lower(ad), '{p}')" for p in _PHRASES)} then concat('DEROGADA: ', SHOWN) end as status from d"""


@query("p18_banner", _BANNER_STATUS_SQL.replace("SHOWN", "left(ad, 80)"))
def p18_banner(spark, sf):
    pages = wide_table(spark, sf, "pages")
    return pages.select("page_id", rules.banner_status("html", [("class", "ad")], _PHRASES, fixed.BANNER_REASON_CHARS).alias("s")).select("page_id", "s.status")


@query("p18_banner_whole", _BANNER_STATUS_SQL.replace("SHOWN", "ad"))
def p18_banner_whole(spark, sf):
    pages = wide_table(spark, sf, "pages")
    return pages.select("page_id", rules.banner_status("html", [("class", "ad")], _PHRASES).alias("s")).select("page_id", "s.status")


@query("p19_status", f"""with norms as ({NORMS_SQL}), s as (select id, {_MARK_SQL} as m, case when id % 13 = 0 then 'DEROGADA: norma derogada' end as b, case when id % 17 = 0 then 'sin respuesta' end as e from norms)
select id, case when e is not null then concat('ERROR: ', e) else coalesce(b, m, 'VIGENTE') end as status, e is not null or coalesce(b, m) is null as is_valid,
 case when e is not null then 'error' when b is not null then 'banner' when m is not null then 'marker' else 'valid' end as outcome from s""")
def p19_status(spark, sf):
    n = norms(spark, sf)
    page = F.when(F.col("id") % 13 == 0, '<div class="x alert-danger"><b>norma derogada</b></div>').otherwise('<div class="alert">hola</div>')
    error = F.when(F.col("id") % 17 == 0, "sin respuesta")
    status = rules.norm_status(rules.banner_status(page), rules.marker_status("raw_text", fixed.MARKER_REASON_CHARS), error, fixed.ERROR_REASON_CHARS)
    return n.select("id", status.alias("s")).select("id", "s.*")


_STATUS_SQL = """with norms as (NORMS), s as (select id, MARK as m, case when id % 13 = 0 then 'DEROGADA: norma derogada' end as b, case when id % 17 = 0 then concat('sin respuesta de ', raw_text) end as e from norms)
select id, case when e is not null then concat('ERROR: ', CUT) else coalesce(b, m, 'VIGENTE') end as status, e is not null or coalesce(b, m) is null as is_valid,
 case when e is not null then 'error' when b is not null then 'banner' when m is not null then 'marker' else 'valid' end as outcome from s""".replace("NORMS", NORMS_SQL)


def _p19(spark, sf, marker=None, error=None):
    n = norms(spark, sf)
    page = F.when(F.col("id") % 13 == 0, '<div class="x alert-danger"><b>norma derogada</b></div>').otherwise('<div class="alert">hola</div>')
    failed = F.when(F.col("id") % 17 == 0, F.concat(F.lit("sin respuesta de "), F.col("raw_text")))
    status = rules.norm_status(rules.banner_status(page), rules.marker_status("raw_text", marker), failed, error)
    return n.select("id", status.alias("s")).select("id", "s.*")


@query("p19_status_cut", _STATUS_SQL.replace("MARK", _MARK_SQL).replace("CUT", "left(e, 50)"))
def p19_status_cut(spark, sf):
    return _p19(spark, sf, fixed.MARKER_REASON_CHARS, fixed.ERROR_REASON_CHARS)


@query("p19_status_whole", _STATUS_SQL.replace("MARK", _MARK_WHOLE_SQL).replace("CUT", "e"))
def p19_status_whole(spark, sf):
    return _p19(spark, sf)


_P20_SQL = f"""with {CODE_BLOCKS_SQL}, b as (select *, strpos(block, '(*)') as p from blocks)
select code_id, article_num, case when p > 0 then 0 else 1 end as label, left(case when p = 0 then block when length(trim(left(block, p - 1))) < 30 then left(block, FALLBACK) else trim(left(block, p - 1)) end, TEXT) as text,
 left(block, RAW) as raw_text from b"""


def _p20_sql(fallback, text, raw):
    return _P20_SQL.replace("FALLBACK", str(fallback)).replace("TEXT", str(text)).replace("RAW", str(raw))


def _p20(spark, sf, **cuts):
    from lexmill.operators.extract import split_code_articles
    from lexmill.plans.corpus import codes

    blocks = split_code_articles(codes(spark, sf), "code_id", "text")
    return rules.label_article(blocks, **cuts).select("code_id", "article_num", "label", "text", "raw_text")


@query("p20_article_labels", _p20_sql(1 << 30, 1 << 30, 1 << 30))
def p20_article_labels(spark, sf):
    return _p20(spark, sf)


@query("p20_article_labels_cut", _p20_sql(20, 60, 80))
def p20_article_labels_cut(spark, sf):
    return _p20(spark, sf, fallback_chars=20, text_chars=60, raw_chars=80)


@query("p22_number", "select doc_id, nullif(regexp_extract(text, '(\\d+)', 1), '') as token from documents")
def p22_number(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.number_token("text").alias("token"))


# --- Filters --------------------------------------------------------------------

@query("f1_valid", f"with norms as ({NORMS_SQL}), l as ({LEVEL_SQL}) select id, level from l where is_valid = 1 and level = 2")
def f1_valid(spark, sf):
    return ingest.keep_valid(rules.with_level(norms(spark, sf)), level=2).select("id", "level")


@query("f1_valid_documents", "select d.doc_id, d.lang from documents d join labels l on l.doc_id = d.doc_id where l.quality = 1")
def f1_valid_documents(spark, sf):
    good = ingest.keep_valid(table(spark, sf, "labels"), valid="quality")
    return table(spark, sf, "documents").select("doc_id", "lang").join(good.select("doc_id"), "doc_id")


@query("f2_sized", "select doc_id, n_chars from documents where length(text) between 1 and 5000")
def f2_sized(spark, sf):
    return ingest.keep_sized(table(spark, sf, "documents"), "text", 5000).select("doc_id", "n_chars")


@query("f3_new_ids", """with r as (select props as id, event_id, row_number() over (partition by props order by ts, event_id) as rn from events where event_type <> 'view')
select id, event_id from r where rn = 1 and id not in (select concat('{"k": ', n_nationkey, '}') from nation)""")
def f3_new_ids(spark, sf):
    rows = table(spark, sf, "events").select(F.when(F.col("event_type") != "view", F.col("props")).otherwise("").alias("id"), "ts", "event_id")
    known = table(spark, sf, "nation").select(F.concat(F.lit('{"k": '), F.col("n_nationkey"), F.lit("}")).alias("id"))
    return ingest.keep_new_ids(rows, "id", ["ts", "event_id"], known).select("id", "event_id")


@query("f4_pending", f"with norms as ({NORMS_SQL}) select id from norms where is_valid is null or id % 3 = 0")
def f4_pending(spark, sf):
    n = norms(spark, sf).withColumn("validation_date", F.when(F.col("id") % 3 != 0, F.col("updated")))
    return ingest.pending(n).select("id")


@query("f5_min_length", "select conv_id, turn, length(text) as n from conversations where length(text) >= 40")
def f5_min_length(spark, sf):
    return min_length(table(spark, sf, "conversations"), "text", 40).select("conv_id", "turn", F.length("text").cast("long").alias("n"))


@query("f6_common", f"""with norms as ({NORMS_SQL}), c as (select title from norms group by title having count(*) >= 5)
select id, title from norms where title in (select title from c)""")
def f6_common(spark, sf):
    from lexmill.operators.dataset import keep_common_classes

    return keep_common_classes(norms(spark, sf).select("id", "title"), "title", 5)


@query("f6_common_levels", f"with norms as ({NORMS_SQL}), l as ({LEVEL_SQL}), m as (select id, level + (id % 3) as level from l) select id, level from m where level between 1 and 5 and level in (select level from m group by level having count(*) >= 5)")
def f6_common_levels(spark, sf):
    from lexmill.operators.dataset import keep_common_classes

    rows = rules.with_level(norms(spark, sf)).select("id", (F.col("level") + F.col("id") % 3).alias("level"))
    return keep_common_classes(rows, "level", 5, 1, 5)


@query("f8_drop_invalid", "select event_id, event_type from events where event_type <> 'error'")
def f8_drop_invalid(spark, sf):
    return ingest.drop_invalid(table(spark, sf, "events").withColumn("is_valid", F.col("event_type") != "error")).select("event_id", "event_type")


@query("f8_drop_counts", "select count(*) filter (event_type <> 'error') as kept, count(*) filter (event_type = 'error') as dropped from events")
def f8_drop_counts(spark, sf):
    return ingest.drop_counts(table(spark, sf, "events").withColumn("is_valid", F.col("event_type") != "error"))
