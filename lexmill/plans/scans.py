"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill import schemas
from lexmill.plans.corpus import NORMS_SQL, STORED_SQL, norms, stored_norms
from lexmill.plans.registry import query, table
from lexmill.session import scratch_path
from lexmill.sources import landing, tables

PAGES = schemas.fields(page_id="long", url="string", html="string")


@query("s1_landing", "select page_id, url, length(html) as n_chars from pages")
def s1_landing(spark, sf):
    pages = landing.read_landing(spark, f"{sf}/pages.parquet", PAGES)
    return pages.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query("s1_search_pages", f"with norms as ({NORMS_SQL}) select concat('H', cast(id as varchar)) as id, type, number from norms")
def s1_search_pages(spark, sf):
    """Result pages landed as JSON lines, read under a fixed schema, one row per document."""
    doc = F.struct(F.concat(F.lit("H"), F.col("id")).alias("id"), F.col("type").alias("dispositivoLegal"), F.col("number").alias("codigoNorma"))
    pages = norms(spark, sf).select(F.lit("1").alias("totalEncontrados"), F.array(doc).alias("resultados"))
    path = scratch_path(spark, "pages")
    pages.write.json(path)
    docs = landing.documents_of_pages(landing.read_landing(spark, path, schemas.SEARCH_PAGE, "json"))
    return docs.select("id", F.col("dispositivoLegal").alias("type"), F.col("codigoNorma").alias("number"))


def search_documents(spark, sf):
    return norms(spark, sf).select(
        F.concat(F.lit("H"), F.col("id")).alias("id"),
        F.when(F.col("id") % 7 != 0, F.col("type")).alias("dispositivoLegal"),
        F.lit("NORMA").alias("palabra"),
        F.col("number").alias("codigoNorma"),
        F.concat(F.lit("<p>"), F.col("title"), F.lit("</p>")).alias("sumilla"),
        F.lit(None).cast("string").alias("fechaPublicacion"),
        F.col("source").alias("sector"),
        F.lit(None).cast("string").alias("highlights"),
    )


def details(spark, sf):
    n = norms(spark, sf)
    return n.where("is_valid is not null").select(
        F.concat(F.lit("H"), F.col("id")).alias("id"),
        F.col("raw_text").alias("textoCompleto"),
        F.when(F.col("id") % 5 == 0, "<Campo no disponible>").when(F.col("id") % 5 != 1, F.concat(F.lit("<b>"), F.col("title"), F.lit("</b>"))).alias("titulo"),
        F.when(F.col("id") % 11 == 0, "sin fecha").otherwise(F.date_format("date", "yyyy-MM-dd")).alias("fechaPublicacion"),
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.lit("DETALLE")).alias("sector"),
        F.concat(F.lit("/"), F.col("type")).alias("ruta"),
    )


# The placeholder is itself shaped like a tag, so stripping tags leaves a blank title and the summary steps in.


@query("s2_items", f"""with norms as ({NORMS_SQL})
select concat('H', cast(id as varchar)) as id, case when id % 7 <> 0 then type else 'NORMA' end as type, number, title,
  case when id % 11 <> 0 then date end as date, case when id % 3 = 0 then source else 'DETALLE' end as source,
  case when id % 10 < 2 then 0 else 1 end as valid, url, sha256(raw_text) as text_hash, concat('/', type) as route
from norms where is_valid is not null""")
def s2_items(spark, sf):
    items = landing.build_items(search_documents(spark, sf), details(spark, sf))
    return items.select("id", "type", "number", "title", "date", "source", F.col("is_valid").cast("int").alias("valid"), "url", "text_hash", "route")


_CATALOG_SQL = """select cast(o_orderkey as bigint) as position, unnest([concat(o_orderpriority, ' ', cast(o_custkey % 40 as varchar)), '', o_orderstatus]) as nombre,
 unnest([0, 1, 2]) as entry_pos from orders"""


@query("s3_catalog", f"""with e as ({_CATALOG_SQL}), r as (select *, row_number() over (partition by nombre order by position, entry_pos) as rn from e where nombre <> '')
select nombre, position, entry_pos from r where rn = 1""")
def s3_catalog(spark, sf):
    entry = [F.concat_ws(" ", "o_orderpriority", (F.col("o_custkey") % 40).cast("string")), F.lit(""), F.col("o_orderstatus")]
    blocks = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("position"), F.array(*[F.struct(e.alias("nombre")) for e in entry]).alias("agrupamientoNormas")
    )
    return landing.flatten_catalog(blocks, "position")


@query("s4_groups", """with c as (select cast(n_nationkey % 12 as varchar) as grupo, n_name as nombre, n_nationkey as position from nation),
cfg as (select * from (values ('1','NR',false,5),('2','NR',false,1),('3','NR',false,1),('4','NR',false,1),('5','NR',false,1),('6','NR',false,1),('7','NR',true,1),('8','JR',false,1)) t(grupo, tipo_norma, buscar_historico, n_groupings)),
k as (select c.grupo as id, nombre as label, tipo_norma, buscar_historico, n_groupings from c join cfg using (grupo) where c.grupo <> '7')
select * from k union all
select grupo, case grupo when '7' then 'PERU HISTORICO' else 'JURISPRUDENCIA' end, tipo_norma, buscar_historico, n_groupings
from cfg where grupo in ('7', '8') and grupo not in (select id from k)""")
def s4_groups(spark, sf):
    """Nations stand for the catalogue; code 7 is marked as no group, so it has to be appended."""
    code = (F.col("n_nationkey") % 12).cast("string")
    catalog = table(spark, sf, "nation").select(
        F.when(code == "7", "NINGUNO").otherwise(code).alias("grupo"), F.col("n_name").alias("nombre"),
        F.lit(None).cast("string").alias("id"), F.col("n_nationkey").alias("position"))
    return landing.resolve_groups(catalog).select(
        "id", "label", "tipo_norma", "buscar_historico", F.size("agrupaciones").alias("n_groupings"))


@query("s5_scan", "select doc_id, text, lang, source, n_chars from documents")
def s5_scan(spark, sf):
    return table(spark, sf, "documents")


@query("s6_samples", "select doc_id, quality from labels")
def s6_samples(spark, sf):
    return tables.read_samples(spark, f"{sf}/labels.parquet", ["doc_id", "quality"])


def _exportable(spark, sf):
    n = norms(spark, sf)
    return n.select("id", "type", "number", "title", "date", "source", "url", "is_valid", F.col("updated").alias("updated_at"))


_EXPORT_SQL = f"""with norms as ({NORMS_SQL}) select cast(id as varchar) as id, type, number, title, strftime(date, '%Y-%m-%d') as date, source, url,
 case is_valid when 1 then 'true' when 0 then 'false' end as is_valid, strftime(updated, '%Y-%m-%dT%H:%M:%S') as updated_at from norms"""


@query("s7_export_csv", _EXPORT_SQL)
def s7_export_csv(spark, sf):
    path = scratch_path(spark, "export")
    tables.export(_exportable(spark, sf), "csv", path)
    names = _exportable(spark, sf).columns
    return spark.read.option("header", True).option("escape", '"').schema(", ".join(f"`{c}` string" for c in names)).csv(path)


@query("s7_export_json", _EXPORT_SQL)
def s7_export_json(spark, sf):
    path = scratch_path(spark, "export")
    tables.export(_exportable(spark, sf), "json", path)
    names = _exportable(spark, sf).columns
    return spark.read.schema(", ".join(f"`{c}` string" for c in names)).json(path)


@query("s8_export_samples", """select concat('C', cast(c.conv_id as varchar)) as code_id, c.role as code_name, cast(c.turn as varchar) as article_num,
 cast(length(c.text) % 2 as varchar) as label, replace(c.text, chr(10), ' ') as text from conversations c""")
def s8_export_samples(spark, sf):
    samples = table(spark, sf, "conversations").select(
        F.concat(F.lit("C"), F.col("conv_id")).alias("code_id"), F.col("role").alias("code_name"),
        F.col("turn").cast("string").alias("article_num"), F.translate("text", "\n", " ").alias("text"),
        (F.length("text") % 2).alias("label"))
    path = scratch_path(spark, "samples")
    tables.export_samples(samples, path)
    return spark.read.option("header", True).option("escape", '"').schema(
        "code_id string, code_name string, article_num string, label string, text string").csv(path)


@query("s9_metrics", "select event_type as metric, round(avg(value), 6) as value from events group by event_type")
def s9_metrics(spark, sf):
    metrics = table(spark, sf, "events").groupBy(F.col("event_type").alias("metric")).agg(F.round(F.avg("value"), 6).alias("value"))
    path = scratch_path(spark, "metrics")
    tables.write_metrics(metrics, path)
    return spark.read.parquet(path)


@query("s10_tables", f"""with s as ({STORED_SQL}) select 'norms' as name, 'filled' as step, (select count(*) from s) as n
 union all select t, 'reset', 0 from (values ('norms'), ('norm_versions'), ('norm_articles'), ('norm_citations'), ('article_samples')) v(t)""")
def s10_tables(spark, sf):
    root = scratch_path(spark, "tables")
    tables.init_tables(spark, root)
    tables.overwrite(stored_norms(spark, sf), f"{root}/norms")
    filled = tables.read_table(spark, root, "norms").count()
    tables.reset(spark, root)
    out = spark.createDataFrame([("norms", "filled", filled)], "name string, step string, n long")
    for name in schemas.TABLES:
        counted = tables.read_table(spark, root, name).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(counted.select(F.lit(name).alias("name"), F.lit("reset").alias("step"), "n"))
    return out


@query("s11_index", """select vec_id, label, len(embedding) as width, round(list_sum(list_transform(embedding, lambda x: x::double * x)), 6) as norm2 from embeddings""")
def s11_index(spark, sf):
    """Written, not written again while present, and loaded back (s14)."""
    path = scratch_path(spark, "index")
    source = table(spark, sf, "embeddings")
    first, second = tables.write_index(source, path), tables.write_index(source.limit(0), path)
    assert first and not second
    x = F.col("embedding").cast("array<double>")
    norm2 = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    return tables.load_index(spark, path).select("vec_id", "label", F.size("embedding").alias("width"), F.round(norm2, 6).alias("norm2"))


@query("s12_conform", f"""with s as ({STORED_SQL}) select id, type, title, url, level, is_valid, cast(null as varchar) as validation_message from s
 union all select id, type, title, url, level, 1, cast(null as varchar) from s""")
def s12_conform(spark, sf):
    """An older table without the validity columns is brought to the newer schema, twice to the same effect."""
    stored = stored_norms(spark, sf)
    old = stored.drop("is_valid", "validation_message", "validation_date")
    once = schemas.conform(old, schemas.NORMS, {"is_valid": 1})
    both = stored.unionByName(schemas.conform(once, schemas.NORMS, {"is_valid": 1}))
    return both.select("id", "type", "title", "url", "level", "is_valid", "validation_message")
