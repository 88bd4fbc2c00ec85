"""Whole jobs on a few landed norms."""

from pyspark.sql import functions as F

from lexmill import jobs, schemas
from lexmill.operators import retrieval


def at(moment):
    return F.lit(moment).cast("timestamp")


def landed(spark, rows):
    """(id, type, title, html) to documents with an order of arrival, and details."""
    docs = spark.createDataFrame([(i, kind, None, f"{n}", title, "2020-01-01", "PCM", None) for n, (i, kind, title, _) in enumerate(rows)], schemas.SEARCH_DOCUMENT)
    details = spark.createDataFrame([(i, html, title, "2020-01-01", "PCM", "/") for i, _, title, html in rows], schemas.DETAIL)
    return docs.withColumn("seq", F.col("codigoNorma").cast("long")), details


def nothing(spark):
    return jobs.Corpus(*[schemas.empty(spark, schemas.TABLES[t]) for t in ("norms", "norm_versions", "norm_articles", "norm_citations")])


ROWS = [
    ("H1", "LEY", "Ley de aguas", "<p>Artículo 1.- Modifica la Ley N° 5.</p><p>Artículo 2.- Fin.</p>"),
    ("H2", "DECRETO SUPREMO", "Reglamento de pesca", "<p>(*) DEROGADO por la Ley 9</p>"),
    ("H3", "COMUNICADO", "Aviso de salud", ""),
]


def test_ingest_validate_and_search(spark, tmp_path):
    early, late = at("2026-01-01 00:00:00"), at("2026-02-01 00:00:00")
    first = jobs.ingest_batch(nothing(spark), *landed(spark, ROWS), early)
    saved = []
    for name, df in zip(("n", "v", "a", "c"), first[:4]):
        df.write.parquet(str(tmp_path / name))
        saved.append(spark.read.parquet(str(tmp_path / name)))
    first = jobs.Corpus(*saved)
    norms = {r["url"][-2:]: r for r in first.norms.collect()}
    assert {k: (r["level"], r["is_valid"]) for k, r in norms.items()} == {"H1": (2, 1), "H2": (3, 0), "H3": (5, 1)}
    assert first.articles.count() == 2 and {r["target_text"] for r in first.citations.collect()} == {"Ley N° 5", "Ley 9"}

    again = jobs.ingest_batch(first, *landed(spark, ROWS), late)
    assert {r["outcome"] for r in again.outcomes.collect()} == {"unchanged"}
    assert again.versions.count() == 3 and again.articles.count() == 2

    only = jobs.ingest_batch(nothing(spark), *landed(spark, ROWS), early, only_valid=True)
    assert {r["url"][-2:] for r in only.norms.collect()} == {"H1", "H3"}
    sized = jobs.ingest_batch(nothing(spark), *landed(spark, ROWS), early, only_valid=True, max_chars=1000)
    assert [r["url"][-2:] for r in sized.norms.collect()] == ["H1"]

    judged = jobs.validate(first.norms.withColumn("is_valid", F.lit(1)), first.versions, late, force=True)
    assert {r["url"][-2:]: (r["new_valid"], r["change"]) for r in judged.collect()} == {"H1": (1, "none"), "H2": (0, "to_invalid"), "H3": (1, "none")}
    assert jobs.validate(first.norms, first.versions, late).count() == 0
    after = {r["url"][-2:]: r for r in jobs.apply_validation(first.norms, judged).collect()}
    assert after["H2"]["validation_message"].startswith("DEROGADA: (*) DEROGADO") and after["H1"]["validation_message"] == "VIGENTE"

    pages = spark.createDataFrame([(norms["H1"]["url"], '<div class="alert">norma derogada</div>')], "url string, html string")
    banner = jobs.validate(first.norms, first.versions, late, force=True, pages=pages)
    assert {r["url"][-2:]: r["new_message"] for r in banner.collect()}["H1"] == "DEROGADA: norma derogada"

    listing = jobs.list_versions(first.norms, first.versions).collect()
    assert {r["norm"] for r in listing} == {"LEY 0", "DECRETO SUPREMO 1", "COMUNICADO 2"} and {r["state"] for r in listing} == {"Inicial"}

    index = jobs.build_index(first.norms, first.versions, retrieval.hashed_terms_encoder(32), only_valid=False)
    queries = spark.createDataFrame([(1, "reglamento de pesca")], "query_id int, query string")
    dense = lambda **kw: [r["title"] for r in jobs.search(index, queries, 2, encoder=retrieval.hashed_terms_encoder(32), **kw).orderBy("rank").collect()]
    assert dense(only_valid=False)[0] == "Reglamento de pesca"
    assert dense()[0] in ("Ley de aguas", "Aviso de salud") and dense(only_valid=False, level=3) == ["Reglamento de pesca"]
    assert set(jobs.profile_corpus(first.norms, first.citations)) == {"summary", "types", "years", "words", "citations"}
    assert jobs.profile_corpus(first.norms, first.citations)["summary"].first()["norms"] == 3


def test_ingest_counts_repeated_ids_once(spark):
    docs, details = landed(spark, [*ROWS, ("", "LEY", "sin id", "<p>x</p>")])
    twice = docs.union(docs.withColumn("seq", F.col("seq") + 10))
    got = jobs.ingest_batch(nothing(spark), twice, details, at("2026-01-01 00:00:00"))
    assert sorted(r["outcome"] for r in got.outcomes.collect()) == ["added"] * 3


def test_ingest_marks_by_page_and_error(spark):
    pages = spark.createDataFrame([("H1", '<div class="alert">norma derogada</div>', None), ("H3", None, "timeout")], "id string, html string, error string")
    got = jobs.ingest_batch(nothing(spark), *landed(spark, ROWS), at("2026-01-01 00:00:00"), pages=pages)
    status = {r["url"][-2:]: (r["is_valid"], r["status"]) for r in got.norms.collect()}
    assert status["H1"] == (0, "DEROGADA: norma derogada") and status["H3"] == (1, "ERROR: timeout") and status["H2"][0] == 0


def test_ingest_never_cuts_a_key(spark):
    far = "H" + "1" * 3000
    docs, details = landed(spark, [(far + "a", "LEY", "t" * 2000, "<p>a</p>"), (far + "b", "LEY", "t", "<p>b</p>")])
    got = jobs.ingest_batch(nothing(spark), docs, details, at("2026-01-01 00:00:00"), limits={"url": 100, "title": 1024})
    assert {r["outcome"] for r in got.outcomes.collect()} == {"added"} and got.norms.count() == 2
    assert sorted(r["cut_fields"] for r in got.outcomes.collect()) == [0, 1]


def test_collector_fills_quotas_with_what_can_be_added(spark):
    rows = [(f"H{i}", "LEY", f"t{i}", "" if i in (1, 2) else f"<p>texto {i}</p>") for i in range(8)]
    docs, details = landed(spark, rows)
    docs = docs.withColumn("group", F.when(F.col("seq") < 6, "A").otherwise("B")).withColumn("fechaPublicacion", F.concat(F.lit("2020-01-0"), F.col("seq") + 1))
    known = spark.createDataFrame([("H5",)], "id string")
    got = jobs.collect_sample(nothing(spark), docs, details, at("2026-01-01 00:00:00"), plan=[("A", "2"), ("A", "1"), ("B", "1")], per_entry=2, target=5, known=known)
    assert {r["url"].rsplit("/", 1)[-1] for r in got.norms.collect()} == {"H0", "H3", "H4", "H6", "H7"}


def test_versions_are_listed_newest_first(spark):
    rows = [(i, i, f"2026-01-{1 + i * 7 % 28:02d} 00:00:00", "h") for i in range(28)]
    versions = schemas.conform(spark.createDataFrame(rows, "id long, norm_id long, version_date string, text_hash string").withColumn("version_date", F.col("version_date").cast("timestamp")), schemas.VERSIONS)
    norms = schemas.conform(spark.range(28).withColumn("type", F.lit("LEY")), schemas.NORMS)
    days = [r["version_day"] for r in jobs.list_versions(norms, versions).collect()]
    assert days == sorted(days, reverse=True) and len(days) == 28


def test_datasets_and_training(spark):
    text = "".join(
        f"<p>Artículo {i}.- Sobre {['aguas', 'minas', 'pesca'][i % 3]} y su trámite número {i % 5} ante la entidad."
        f"{' (*) Artículo derogado por la Ley N° 1.' if i % 2 else ''}</p>" for i in range(60))
    codes = spark.createDataFrame([(f"C{n}", f"CODIGO {n}", text) for n in range(3)], "code_id string, code_name string, html string")
    samples = jobs.validity_dataset(codes, ratio=1.0)
    counts = {r["label"]: r["n"] for r in samples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 90, 1: 90}
    report = jobs.train_validity(samples)
    rows = {r["class"]: r for r in report.report.collect()}
    assert rows["accuracy"]["f1"] == 1.0 and rows["accuracy"]["support"] == 27
    assert report.cv.first()["mean"] == 1.0 and report.confusion.count() == 4
