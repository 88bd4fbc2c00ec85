"""Landing, catalogues, exports, table set-up, index."""

import json

from pyspark.sql import functions as F

from lexmill import fixed, schemas
from lexmill.sources import landing, tables


def test_items_from_documents_and_details(spark):
    docs = spark.createDataFrame([
        ("H1", "LEY", None, "1", "<p>Sumilla <b>uno</b></p>", "2020-01-01", "PCM", None),
        ("H2", "", "DECRETO", "2", "resumen", None, None, None),
        ("H3", "LEY", None, "3", None, None, None, None),
        ("H4", "LEY", None, "4", "sin detalle", None, None, None),
    ], schemas.SEARCH_DOCUMENT)
    details = spark.createDataFrame([
        ("H1", "<p>texto</p>", "<h1>Título</h1>", "2021-05-05", "MINSA", "/a/b"),
        ("H2", "(*) DEROGADO por ley", "", "mal", None, None),
        ("H3", None, None, None, None, None),
    ], schemas.DETAIL)
    got = {r["id"]: r for r in landing.build_items(docs, details).collect()}
    assert set(got) == {"H1", "H2", "H3"}
    assert (got["H1"]["title"], str(got["H1"]["date"]), got["H1"]["source"], got["H1"]["is_valid"]) == ("Título", "2021-05-05", "MINSA", True)
    assert (got["H2"]["type"], got["H2"]["title"], got["H2"]["date"], got["H2"]["is_valid"]) == ("DECRETO", "resumen", None, False)
    assert (got["H3"]["title"], got["H3"]["raw_text"]) == ("3", "")
    assert json.loads(got["H1"]["metadata_json"])["agrupacion"] == "/a/b"


def test_catalogue_keeps_first_of_each_name(spark):
    blocks = spark.createDataFrame([(0, [("a",), ("",), ("b",)]), (1, [("b",), (None,), ("c",)])], "p int, agrupamientoNormas array<struct<nombre: string>>")
    assert sorted((r["nombre"], r["p"]) for r in landing.flatten_catalog(blocks, "p").collect()) == [("a", 0), ("b", 0), ("c", 1)]


def test_groups_fall_back(spark):
    catalog = spark.createDataFrame([("1", None, "x", 0), ("NINGUNO", "n", "y", 1), ("99", "z", None, 2), ("7", "Hist", None, 3)],
                                    "grupo string, nombre string, id string, position int")
    got = [(r["id"], r["label"]) for r in landing.resolve_groups(catalog).orderBy("position").collect()]
    assert got == [("1", "x"), ("7", "Hist"), ("8", fixed.SEARCH_GROUPS[7][1])]
    assert landing.global_group(spark).first()["id"] == "GLOBAL"


def test_tables_are_made_once_and_reset(spark, tmp_path):
    root = str(tmp_path)
    assert sorted(tables.init_tables(spark, root)) == sorted(schemas.TABLES)
    assert tables.init_tables(spark, root) == []
    one = schemas.conform(spark.createDataFrame([("u",)], "url string"), schemas.NORMS)
    tables.overwrite(one, f"{root}/norms")
    assert tables.read_table(spark, root, "norms").count() == 1
    tables.reset(spark, root)
    assert tables.read_table(spark, root, "norms").count() == 0


def test_export_round_trip(spark, tmp_path):
    title = 'con "comillas", coma y\nlínea'
    df = schemas.conform(spark.createDataFrame([(1, title, "u", 0)], "id long, title string, url string, is_valid int"), schemas.NORMS)
    df = df.withColumn("date", F.lit("2020-02-03").cast("date")).withColumn("created_at", F.lit("2020-02-03 04:05:06").cast("timestamp"))
    tables.export(df, "csv", str(tmp_path / "c"))
    row = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "c")).first()
    assert (row["title"], row["is_valid"], row["date"], row["created_at"]) == (title, "false", "2020-02-03", "2020-02-03T04:05:06")
    tables.export(df, "json", str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["title"] == title


def test_index_is_kept_unless_rebuilt(spark, tmp_path):
    path = str(tmp_path / "i")
    one, two = spark.range(1), spark.range(2)
    assert tables.write_index(one, path) and not tables.write_index(two, path)
    assert tables.load_index(spark, path).count() == 1
    assert tables.write_index(two, path, rebuild=True) and tables.load_index(spark, path).count() == 2
