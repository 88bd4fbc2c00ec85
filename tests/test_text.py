"""Text functions and rules on literal cases."""

import hashlib
from html import unescape

import pytest
from pyspark.sql import functions as F

from lexmill.functions import html, rules, text, tokens


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{k} string" for k in values) or "x int")
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("page, sep, expected", [
    ("<p>Hola <b>mundo</b></p>", "\n", "Hola\nmundo"),
    ("<p>a<!-- no --> b</p>", " ", "a b"),
    ('<script>var t="</p>";</script><p>x</p><style>p{}</style>', " ", "x"),
    ("<p>sin cerrar<p>otra", "|", "sin cerrar|otra"),
    ('<a title="a > b">t</a>', " ", "t"),
    ("<p>5 < 6 y 7 > 3</p>", " ", "5 < 6 y 7 > 3"),
    ("<p>&lt;b&gt; &amp;amp; &#209;&#xF1; &nada; A&B</p>", " ", "<b> &amp; Ññ &nada; A&B"),
    ("<p>&nbsp;x&nbsp;</p>", " ", "x"),
    ("solo texto < sin cierre", " ", "solo texto < sin cierre"),
    ("", " ", ""),
])
def test_html_to_text(spark, page, sep, expected):
    assert one(spark, html.html_to_text("h", sep), h=page) == expected


def test_entities_follow_the_standard_names(spark):
    names = ["&eacute;", "&Ntilde;", "&ordm;", "&laquo;", "&euro;", "&#8220;", "&copy;", "&quot;"]
    source = " ".join(names)
    assert one(spark, html.decode_entities(F.col("h")), h=source) == unescape(source)


def test_bad_code_point_does_not_fail(spark):
    assert one(spark, html.decode_entities(F.col("h")), h="&#xD800;&#9999999;") == "��"


def test_squash_covers_no_break_space(spark):
    assert one(spark, text.squash("h"), h="  a \t\n b ") == "a b"


def test_strip_keeps_inner_whitespace(spark):
    assert one(spark, text.strip("h"), h="\n a \n b\t") == "a \n b"


def test_fold(spark):
    assert one(spark, text.fold("h"), h="CONSTITUCIÓN Ñandú Über Café") == "constitucion nandu uber cafe"


def test_hash_of_null(spark):
    assert one(spark, text.content_hash(F.lit(None).cast("string"))) == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("url, tail", [("https://h/#/detallenorma/H12", "H12"), ("https://h/a/H9///", "H9")])
def test_url_tail(spark, url, tail):
    assert one(spark, text.url_tail("u"), u=url) == tail


@pytest.mark.parametrize("value, expected", [("2024-02-30", None), ("nope", None), (None, None), ("2024-02-29", "2024-02-29")])
def test_safe_date(spark, value, expected):
    assert one(spark, text.safe_date("d").cast("string"), d=value) == expected


@pytest.mark.parametrize("kind, title, level", [
    ("DECRETO SUPREMO", "", 3), ("RESOLUCION LEGISLATIVA", "", 2), ("RESOLUCION SUPREMA", "", 4), ("", "Código Civil", 2),
    ("COMUNICADO", "", 5), (None, None, 5), ("Reforma Constitucional", "x", 1), ("ACUERDO DE CONCEJO", "Ley", 4),
])
def test_level(spark, kind, title, level):
    assert one(spark, rules.level("k", "t"), k=kind, t=title) == level


def test_marker_left_without_effect(spark):
    got = one(spark, rules.marker_status("t"), t="TITULO (*) DEJADA SIN EFECTO por el Artículo 1 de la Resolución")
    assert got["is_valid"] is False and got["status"].startswith("SIN EFECTO: (*) DEJADA SIN EFECTO")


def test_marker_repealed_starts_at_second_star(spark):
    got = one(spark, rules.marker_status("t"), t="NORMA (*) (*) DEROGADO por el Numeral 2.3")
    assert got["status"] == "DEROGADA: (*) DEROGADO por el Numeral 2.3"


def test_marker_absent_and_reason_length(spark):
    assert one(spark, rules.marker_status("t"), t="Derogado en parte") is None
    assert len(one(spark, rules.marker_status("t", 200), t="(*) derogado " + "x" * 500)["status"]) == len("DEROGADA: ") + 200
    assert one(spark, rules.marker_status("t"), t="(*) derogado " + "x" * 500)["status"] == "DEROGADA: (*) derogado " + "x" * 500


def test_banner_and_error_whole_unless_cut(spark):
    page = '<div class="alert">norma derogada ' + "y" * 300 + "</div>"
    assert one(spark, rules.banner_status("h"), h=page)["status"] == "DEROGADA: norma derogada " + "y" * 300
    assert len(one(spark, rules.banner_status("h", reason_chars=80), h=page)["status"]) == len("DEROGADA: ") + 80
    none = F.lit(None).cast("struct<is_valid: boolean, status: string>")
    assert one(spark, rules.norm_status(none, none, F.lit("e" * 90)))["status"] == "ERROR: " + "e" * 90
    assert one(spark, rules.norm_status(none, none, F.lit("e" * 90), 50))["status"] == "ERROR: " + "e" * 50


@pytest.mark.parametrize("page, expected", [
    ('<div class="alert alert-danger">Esta <b>norma</b> ha sido <i>derogada</i></div>', None),
    ('<div class="alert-danger"><div>Aviso:</div><div>norma derogada</div></div><div>otra</div>', "DEROGADA: Aviso:norma derogada"),
    ("<p class='estado-norma'>NO VIGENTE</p>", "DEROGADA: NO VIGENTE"),
    ('<p>norma derogada</p><div class="content">sin efecto</div>', None),
    ('<p class="warning">sin efecto</p><p class="alert-info">revocada</p>', "DEROGADA: revocada"),
    ('<p class="my-alert-box">quedó anulada</p>', "DEROGADA: quedó anulada"),
    ('<!-- <p class="alert">anulada</p> -->', None),
])
def test_banner(spark, page, expected):
    got = one(spark, rules.banner_status("h"), h=page)
    assert (got and got["status"]) == expected


def test_banner_text_joins_pieces_without_space(spark):
    got = one(spark, rules.banner_status("h"), h='<div class="alert">norma <b>derogada</b></div>')
    assert got is None  # pieces are stripped and joined, so the phrase is not found


def test_status_order(spark):
    banner, none = F.struct(F.lit(False).alias("is_valid"), F.lit("B").alias("status")), F.lit(None).cast("struct<is_valid: boolean, status: string>")
    assert one(spark, rules.norm_status(banner, none))["outcome"] == "banner"
    assert one(spark, rules.norm_status(none, none))["status"] == "VIGENTE"
    failed = one(spark, rules.norm_status(banner, none, F.lit("timeout")))
    assert (failed["is_valid"], failed["status"], failed["outcome"]) == (True, "ERROR: timeout", "error")


def test_repeal_note_and_body(spark):
    block = "Artículo 5.- El contenido del artículo es suficientemente largo. (*) Artículo derogado por la Ley"
    df = spark.createDataFrame([(block,)], "block string")
    got = rules.label_article(df).first()
    assert (got["label"], got["text"]) == (0, "Artículo 5.- El contenido del artículo es suficientemente largo.")
    assert got["raw_text"] == block


def test_short_body_falls_back_to_raw(spark):
    block = "Artículo 6.- Nada. (*) Numeral dejado sin efecto " + "y" * 400
    frame = spark.createDataFrame([(block,)], "block string")
    assert rules.label_article(frame).first()["text"] == block
    got = rules.label_article(frame, fallback_chars=300).first()
    assert got["label"] == 0 and got["text"] == block[:300]


@pytest.mark.parametrize("value, expected", [("608-2025/MINSA", "608"), ("s/n", None), ("A12B34", "12")])
def test_number_token(spark, value, expected):
    assert one(spark, text.number_token("n"), n=value) == expected


def test_embedding_text_skips_blanks(spark):
    got = one(spark, text.embedding_text(F.col("a"), F.col("b"), F.col("c"), F.col("d")), a="LEY", b=None, c="", d="x" * 1200)
    assert got == "LEY. " + "x" * 1200
    got = one(spark, text.embedding_text(F.col("a"), F.col("b"), F.col("c"), F.col("d"), 1000), a="LEY", b=None, c="", d="x" * 1200)
    assert got == "LEY. " + "x" * 1000


def test_entities_as_browsers_read_them(spark):
    import html as standard
    from html.entities import html5

    from lexmill.functions.html import decode_entities

    forms = [f"a&{name} b" for name in html5] + [f"x&{name}y" for name in ("amp", "nbsp", "copy2020", "notin", "notit;", "frac12", "unknown;", "AMP", "ampamp;")]
    forms += [f"&#{n};z" for n in (0, 9, 10, 13, 65, 127, 128, 129, 145, 150, 159, 160, 55296, 65534, 128512, 1114111, 1114112, 99999999999)]
    forms += [f"&#x{n}" for n in ("41", "96;", "d800;", "1F600;", "ffffffff;", "0000041;")] + ["&;", "& b", "&#;", "&#x;", "a&b&lt", "&#65", "&amp;lt;"]
    got = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, t string").select("i", decode_entities(F.col("t")).alias("d")).collect()
    wrong = [(forms[r["i"]], r["d"], standard.unescape(forms[r["i"]])) for r in got if r["d"] != standard.unescape(forms[r["i"]])]
    assert not wrong, wrong[:10]


def test_tokens(spark):
    assert one(spark, tokens.tokens_ws("t"), t=" La ley, LEY \n 5 ") == ["la", "ley,", "ley", "5"]
    assert one(spark, tokens.tokens_words("t"), t="La ley N° 5, año_1 y él") == ["la", "ley", "año_1", "él"]
    assert one(spark, tokens.tokens_ngrams("t"), t="uno dos tres") == ["uno", "dos", "tres", "uno dos", "dos tres"]
    assert one(spark, tokens.tokens_ngrams("t"), t="x") == []
    assert one(spark, tokens.title_words("t"), t="Ley que aprueba el Presupuesto 2020 y a") == ["presupuesto", "2020"]


def test_term_counts(spark):
    got = one(spark, tokens.term_counts(tokens.tokens_ws("t")), t="b a b c b a")
    assert [(r["term"], r["tf"]) for r in got] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(spark, tokens.term_counts(tokens.tokens_ws("t")), t="  ") is None


def test_status_reads_its_text_once(spark):
    """The marker is sought once in a text made once, and text without tags skips their patterns with the same outcome."""
    from lexmill.functions.html import html_to_text, text_segments
    from lexmill.functions.rules import marker_status, norm_status
    from lexmill.functions.text import OUTER_WHITESPACE, strip

    none = F.lit(None).cast("struct<is_valid: boolean, status: string>")
    plan = spark.range(1).select(norm_status(none, marker_status(F.upper(F.col("id").cast("string")), 20)).alias("s"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract(") == 1 and plan.count("upper(cast(") == 1
    texts = [None, "", "  ", "a", " a\n ", " \n a b \t", "a &amp; b &lt;i&gt; ", "<p> a </p> b", "\u0001a < b ", "a ", "&nbsp;x&nbsp;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.array_join(text_segments(F.coalesce("t", F.lit(""))), " ")
    for r in df.select("t", html_to_text("t", " ", always=True).alias("a"), whole.alias("b"), strip("t").alias("c"), F.regexp_replace("t", OUTER_WHITESPACE, "").alias("d")).collect():
        assert r["a"] == r["b"] and r["c"] == r["d"], r["t"]
