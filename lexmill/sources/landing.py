"""Landed input: search documents, details, catalogues, and the items built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill import fixed
from lexmill.functions.html import html_to_text
from lexmill.functions.rules import banner_status, marker_status, norm_status
from lexmill.functions.text import content_hash, detail_url, pick_title, present, safe_date
from lexmill.operators.skew import first_by


def read_landing(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Landed files under a fixed schema; nothing is inferred."""
    return spark.read.schema(schema).format(fmt).load(path)


def documents_of_pages(pages: DataFrame) -> DataFrame:
    """Search documents out of landed result pages."""
    return pages.select(F.explode("resultados").alias("d")).select("d.*")


def flatten_catalog(blocks: DataFrame, position: str, entries: str = "agrupamientoNormas", name: str = "nombre") -> DataFrame:
    """Entries of nested catalogue blocks: blank names dropped, the first of each name kept."""
    rows = blocks.select(F.col(position), F.posexplode(entries).alias("entry_pos", "entry"))
    rows = rows.select(F.col(f"entry.{name}").alias(name), position, "entry_pos")
    return first_by(rows.where(present(name).isNotNull()), [name], [position, "entry_pos"])


def group_config(spark: SparkSession) -> DataFrame:
    """The fixed search groups as a table."""
    return spark.createDataFrame(
        [(g, i, label, groupings, kind, historic) for i, (g, label, groupings, kind, historic) in enumerate(fixed.SEARCH_GROUPS)],
        "grupo string, config_pos int, label string, agrupaciones array<string>, tipo_norma string, buscar_historico boolean",
    )


def resolve_groups(catalog: DataFrame, position: str = "position") -> DataFrame:
    """Catalogue entries joined to the fixed groups; two groups always present; one global row when none is left.

    The configuration has eight rows, so it is broadcast.
    """
    spark = catalog.sparkSession
    config = group_config(spark)
    known = (
        catalog.where(present("grupo").isNotNull() & (F.col("grupo") != fixed.GROUP_NONE))
        .join(F.broadcast(config), "grupo")
        .select(
            F.col("grupo").alias("id"),
            F.coalesce(present("nombre"), present(F.col("id")), present("label"), "grupo").alias("label"),
            "agrupaciones", "tipo_norma", "buscar_historico", F.col(position).cast("long").alias("position"),
        )
    )
    extra = config.where(F.col("grupo").isin(fixed.ALWAYS_PRESENT_GROUPS)).select(
        F.col("grupo").alias("id"), "label", "agrupaciones", "tipo_norma", "buscar_historico",
        (F.lit(2**62) + F.col("config_pos")).alias("position"),
    )
    present_ids = known.select("id").distinct()
    return known.unionByName(extra.join(present_ids, "id", "left_anti"))


def global_group(spark: SparkSession) -> DataFrame:
    """The one empty group to search when no group could be resolved."""
    gid, label, groupings, kind, historic = fixed.GLOBAL_GROUP
    return spark.createDataFrame(
        [(gid, label, groupings, kind, historic, 0)],
        "id string, label string, agrupaciones array<string>, tipo_norma string, buscar_historico boolean, position long",
    )


def with_detail(docs: DataFrame, details: DataFrame, id: str) -> DataFrame:
    """Documents whose detail was fetched; the others drop out."""
    return docs.join(details, id)


def build_items(docs: DataFrame, details: DataFrame, base_url: str = "https://example.org/#/detallenorma/",
                page_html: Column | None = None, error: Column | None = None, keep: list[str] = ()) -> DataFrame:
    """Norm items from search documents and their details, with the columns `keep` of the documents.

    Titles and summaries lose their tags, the status comes from banner and
    marker, and the hash is that of the published text.
    """
    d, t = docs.alias("d"), details.alias("t")
    joined = d.join(t, F.col("d.id") == F.col("t.id"))
    raw = F.coalesce(F.col("t.textoCompleto"), F.lit(""))
    summary = html_to_text(F.col("d.sumilla"), " ", always=True)
    title = html_to_text(F.coalesce(present(F.col("t.titulo")), F.col("d.sumilla")), " ", always=True)
    banner = banner_status(page_html, reason_chars=fixed.BANNER_REASON_CHARS) if page_html is not None else F.lit(None).cast("struct<is_valid: boolean, status: string>")
    status = norm_status(banner, marker_status(html_to_text(raw, " ", always=True), fixed.MARKER_REASON_CHARS), error, fixed.ERROR_REASON_CHARS)
    return joined.select(
        F.col("d.id").alias("id"),
        F.coalesce(present(F.col("d.dispositivoLegal")), F.col("d.palabra")).alias("type"),
        F.col("d.codigoNorma").alias("number"),
        pick_title(title, summary, F.col("d.codigoNorma"), F.col("d.id"), fixed.TITLE_PLACEHOLDER).alias("title"),
        safe_date(F.coalesce(present(F.col("t.fechaPublicacion")), present(F.col("d.fechaPublicacion")))).alias("date"),
        F.coalesce(present(F.col("t.sector")), F.col("d.sector")).alias("source"),
        status.alias("_status"),
        detail_url(F.col("d.id"), base_url).alias("url"),
        content_hash(raw).alias("text_hash"),
        raw.alias("raw_text"),
        F.col("t.ruta").alias("route"),
        F.col("d.sumilla").alias("summary_html"),
        F.to_json(F.struct(F.col("t.ruta").alias("agrupacion"), F.struct(
            F.col("d.id").alias("id"), F.col("d.palabra").alias("palabra"), F.col("d.highlights").alias("highlight")
        ).alias("solr_doc"))).alias("metadata_json"),
        *[F.col(f"d.{c}").alias(c) for c in keep],
    ).select("*", "_status.status", "_status.is_valid", "_status.outcome").drop("_status")
