"""Articles and citations on literal cases, and as properties of made-up texts."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexmill import fixed
from lexmill.operators.extract import extract_articles, extract_citations, split_code_articles


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string")


def articles(spark, value):
    return [(r["number"], r["content"], r["order"]) for r in extract_articles(texts(spark, value), "id", "text").orderBy("order").collect()]


def citations(spark, value, **caps):
    return [(r["target_text"], r["citation_type"]) for r in extract_citations(texts(spark, value), "id", "text", **caps).orderBy("order").collect()]


@pytest.mark.parametrize("value, numbers", [
    ("Artículo 1.- a\nArt. 2.- b", ["1", "2"]),
    ("Artículo 12°.- x", ["12°"]),
    ("Artículo 5º El texto", []),
    ("texto sin encabezados", []),
    ("ver el Artículo 3. de", []),
    ("ARTÍCULO 7-A.- x\n\n  art 8) y", ["7-A", "8"]),
    ("<p>Artículo 1.- a</p><p>Artículo 2.- b</p>", ["1", "2"]),
    (None, []),
])
def test_article_numbers(spark, value, numbers):
    assert [n for n, _, _ in articles(spark, value)] == numbers


def test_article_content_and_order(spark):
    got = articles(spark, "Preámbulo\nArtículo 1.- uno\nsigue\n\n Artículo 2.- dos ")
    assert got == [("1", "Artículo 1.- uno\nsigue", 1), ("2", "Artículo 2.- dos", 2)]


def test_article_caps(spark):
    many = "\n".join(f"Artículo {i}.- texto {i}" for i in range(1, 10))
    rows = extract_articles(texts(spark, many), "id", "text", max_articles=4, max_chars=10).collect()
    assert len(rows) == 4 and all(len(r["content"]) == 10 for r in rows)


def test_code_splitter_finds_heading_inside_a_line(spark):
    df = texts(spark, "ver el Artículo 3. de esta norma, con cuarenta letras o más en total", "Artículo 4. corto", "artículo 9. en minúscula no cuenta nunca en los códigos")
    assert [r["article_num"] for r in split_code_articles(df, "id", "text").collect()] == ["3"]


@pytest.mark.parametrize("value, expected", [
    ("Derógase la Ley N° 100", [("Ley N° 100", "repeals")]),
    ("Modifica la Ley N° 200", [("Ley N° 200", "modifies")]),
    ("derogada por la Ley N° 300", [("Ley N° 300", "repeals")]),
    ("sustituida por la Ley N° 400", [("Ley N° 400", "repealed_by")]),
    ("Ley N°500", []),
    ("según la Ley  5 y la LEY 5", [("Ley 5", "refers"), ("LEY 5", "refers")]),
    ("D.L. 19990, DU Nº 004-2020, D.S. 009-2005-TR, RM 12-34-MINSA", [
        ("D.L. 19990", "refers"), ("DU Nº 004-2020", "refers"), ("D.S. 009-2005-TR", "refers"), ("RM 12-34-MINSA", "refers")]),
    ("el código penal y la CONSTITUCIÓN POLÍTICA", [("código penal", "refers"), ("CONSTITUCIÓN POLÍTICA", "refers")]),
])
def test_citations(spark, value, expected):
    assert citations(spark, value) == expected


def test_citation_repeat_keeps_first_type(spark):
    far = "x" * 60
    assert citations(spark, f"Modifica la Ley N° 7. {far} Derógase la Ley N° 7") == [("Ley N° 7", "modifies")]


def test_citation_context_is_fifty_characters(spark):
    assert citations(spark, "deroga" + "y" * 44 + "Ley 8") == [("Ley 8", "repeals")]
    assert citations(spark, "deroga" + "y" * 45 + "Ley 8") == [("Ley 8", "refers")]


def test_citation_context_reaches_over_other_citations(spark):
    assert citations(spark, "Deroga Ley 1, Ley 2, Ley 3, Ley 4") == [(f"Ley {i}", "repeals") for i in (1, 2, 3, 4)]


def test_citation_cap(spark):
    assert len(citations(spark, " ".join(f"Ley {i}" for i in range(40)), max_citations=5)) == 5


CUES = ["", "Derógase la ", "Modifica la ", "sustituida por la ", "en la ", "\n", "  "]
PARTS = st.lists(st.tuples(st.sampled_from(CUES), st.sampled_from(["Ley N° ", "ley ", "D.S. 0", "DL", "Decreto Legislativo Nº "]),
                           st.integers(1, 40), st.sampled_from(["", ".", "-2020-PCM ", " y ", "\n"])), max_size=12)


def brute_citations(value):
    """The rule said directly: patterns in turn, matches in turn, first of each text."""
    seen = {}
    for pattern, _ in fixed.CITATION_PATTERNS:
        for m in re.finditer(pattern, value, re.IGNORECASE):
            before = value[max(0, m.start() - 50):m.start()].lower()
            kind = next((k for k, cues in fixed.CITATION_CUES if any(c in before for c in cues)), "refers")
            seen.setdefault(" ".join(m.group(0).split()), kind)
    return list(seen.items())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PARTS, min_size=1, max_size=20))
def test_citations_match_brute_force(spark, docs):
    values = ["".join(f"{a}{b}{c}{d}" for a, b, c, d in parts) for parts in docs]
    rows = extract_citations(texts(spark, *values), "id", "text").orderBy("id", "order").collect()
    got = {i: [] for i in range(len(values))}
    for r in rows:
        got[r["id"]].append((r["target_text"], r["citation_type"]))
    assert got == {i: brute_citations(v) for i, v in enumerate(values)}


HEADS = st.lists(st.tuples(st.sampled_from(["", "texto ", "\n", "\n\n "]), st.sampled_from(["Artículo ", "Art. ", "ARTÍCULO  ", "Art "]),
                           st.integers(1, 99), st.sampled_from([".- ", "° ", ") ", " ", "-A.- "]), st.sampled_from(["uno", "dos\ntres", ""])), max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(HEADS, min_size=1, max_size=20))
def test_articles_rebuild_the_text(spark, docs):
    """Contents put together again are the text from the first heading on, up to outer whitespace."""
    values = ["".join(map(str, (x for part in parts for x in part))) for parts in docs]
    rows = extract_articles(texts(spark, *values), "id", "text").orderBy("id", "order").collect()
    pattern = re.compile(fixed.ARTICLE_HEADING, re.IGNORECASE | re.MULTILINE)
    for i, value in enumerate(values):
        mine = [r for r in rows if r["id"] == i]
        found = list(pattern.finditer(value))
        assert [r["number"] for r in mine] == [m.group(1) for m in found]
        if found:
            squeezed = "".join("".join(r["content"].split()) for r in mine)
            assert squeezed == "".join(value[found[0].start():].split())


def test_very_long_text(spark):
    """Whole texts of megabytes pass, and cost grows with their length only."""
    n = 30_000
    value = "<p>" + "</p>\n<p>".join(f"Artículo {i}.- Modifica la Ley N° {i % 5000} y &eacute;l" for i in range(n)) + "</p><script>" + "x" * 1_000_000 + "</script>" + " \n" * 20_000
    df = texts(spark, value)
    assert extract_articles(df, "id", "text").count() == n
    rows = extract_citations(df, "id", "text")
    assert rows.count() == 5000
    assert rows.where("citation_type = 'modifies'").count() == 5000


def test_patterns_are_tried_only_where_the_words_they_need_stand(spark):
    """Each pattern's own words let it be tried, in any case and with the letters that match s, i and k."""
    from pyspark.sql import functions as F

    from lexmill.operators import extract

    assert len(fixed.CITATION_NEEDS) == len(fixed.CITATION_PATTERNS)
    texts = ["LEY N° 12", "decreto leg\u0130slativo 7", "D.l. 8", "decreto de urgenc\u0131a 9-1", "du 10", "DECRETO \u017fUPREMO 1-2-AB", "d\u017f 3-4-CD",
             "re\u017foluci\u00d3n ministerial 5-6-EF", "rm 7-8-GH", "C\u00d3DIGO PENAL", "c\u00f3digo c\u0130vil", "CONSTITUCI\u00d3N POL\u00cdTICA", "nada"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    tried = F.concat(*[extract._pattern_matches(F.col("text"), i, p, label) for i, (p, label) in enumerate(fixed.CITATION_PATTERNS)])
    want = {r["id"]: r["n"] for r in df.select("id", F.size(F.array_distinct(F.transform(tried, lambda m: m["target_text"]))).alias("n")).collect()}
    got = {r["id"]: r["n"] for r in df.select("id", F.size(extract.citations_of(F.col("text"))).alias("n")).collect()}
    assert got == want and sum(n > 0 for n in want.values()) >= 10
