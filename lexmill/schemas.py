"""Table schemas, empty tables, and conforming a table to a newer schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "vector": T.ArrayType(T.FloatType()),
}


def fields(**types: str) -> T.StructType:
    """A schema from name=type; a trailing `!` forbids nulls."""
    return T.StructType([T.StructField(n.rstrip("_"), _TYPES[t.rstrip("!")], not t.endswith("!")) for n, t in types.items()])


NORMS = fields(
    id="long", type="string", number="string", title="string", date="date", source="string", status="string",
    url="string!", text_hash="string", level="int", is_valid="int", validation_message="string",
    validation_date="timestamp", created_at="timestamp", updated_at="timestamp", last_hash="string", last_updated_at="timestamp",
)
VERSIONS = fields(id="long", norm_id="long!", version_date="timestamp", text_hash="string!", raw_text="string", metadata_json="string")
ARTICLES = fields(norm_id="long!", number="string", content="string", order="int!")
CITATIONS = fields(norm_id="long!", target_text="string!", citation_type="string", source_type="string", order="int")
SAMPLES = fields(code_id="string", code_name="string", article_num="string", text="string", raw_text="string", label="int")
INDEX_META = fields(
    norm_id="long", title="string", type="string", number="string", url="string", level="int", is_valid="boolean",
    status="string", embedding="vector",
)
TABLES = {"norms": NORMS, "norm_versions": VERSIONS, "norm_articles": ARTICLES, "norm_citations": CITATIONS, "article_samples": SAMPLES}

# Landed records
SEARCH_DOCUMENT = fields(
    id="string", dispositivoLegal="string", palabra="string", codigoNorma="string", sumilla="string",
    fechaPublicacion="string", sector="string", highlights="string",
)
DETAIL = fields(id="string", textoCompleto="string", titulo="string", fechaPublicacion="string", sector="string", ruta="string")
SEARCH_PAGE = T.StructType([
    T.StructField("totalEncontrados", T.StringType()),
    T.StructField("resultados", T.ArrayType(SEARCH_DOCUMENT)),
])
CATALOG_BLOCK = T.StructType([T.StructField("agrupamientoNormas", T.ArrayType(fields(nombre="string")))])
CATALOG_ENTRY = fields(grupo="string", nombre="string", id="string")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Columns of `schema` in its order and types; missing ones get their default or null. Safe to repeat."""
    defaults = defaults or {}
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
