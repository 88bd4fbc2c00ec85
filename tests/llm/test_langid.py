"""Language identification: vectors against plain counting, held-out accuracy, rejection."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from llm_fixtures import odd_documents, without_rows
from pyspark.sql import functions as F

from lexmill.llm import langid


def plain_sequence(text):
    out = " "
    for c in text.lower():
        c = c if c.isalpha() else " "
        out += "" if c == " " == out[-1] else c
    return out if out[-1] == " " else out + " "


def test_counts_equal_plain_ngrams(monkeypatch):
    rng = random.Random(5)
    texts = ["Hello, World!", "ÀÉ 漢字 ñandú", "a", "x1y2  z", "ends ", " begins", "İstanbul"] + ["".join(rng.choice("ab é.漢 \n") for _ in range(80)) for _ in range(30)]
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(langid, "_CHUNK", chunk)
        for text in texts:
            codes = [ord(c) for c in plain_sequence(text)]
            expected = np.zeros(langid.DIM, np.int64)
            for n, grams in ((1, codes[1:]), (2, codes), (3, codes)):
                for i in range(len(grams) - n + 1):
                    expected[int(langid._places(np.array(grams[i:i + n], np.uint32), n)[0])] += 1
            found = langid.ngram_counts(text)
            assert found is None if not any(c.isalpha() for c in text) else (found == expected).all(), text
    assert langid.ngram_counts("42 !?") is None and langid.ngram_counts("") is None


def test_places_part_different_ngrams():
    grams = [np.array([a, b, c], np.uint32) for a in range(97, 123) for b in range(97, 123) for c in (97, 101, 233)]
    met = Counter(int(langid._places(g, 3)[0]) for g in grams)
    assert max(met.values()) < 8 and len(met) > 0.9 * len(grams)


def test_idf_covers_every_row(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "ab ab"), (3, "b"), (4, "12")], "doc_id long, text string").repartition(3)
    met, n = langid._document_frequency(df, "text")
    assert n == 3
    assert met[int(langid._places(np.array([97], np.uint32), 1)[0])] == 2 and met[int(langid._places(np.array([98], np.uint32), 1)[0])] == 3


def test_held_out_accuracy_and_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in langid.op13_language_id(spark, sf_dir).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert set(rows) == set(truth)
    for doc_id, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [d for d in rows if rows[d]["held_out"]]
    assert len(held) > 20 and sum(rows[d]["lang_pred"] == truth[d] for d in held) >= 0.97 * len(held)


def test_held_out_labels_and_other_columns_play_no_part(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 120")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit_languages(docs.where(~held), "text", "lang")
    other = langid.fit_languages(docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))).where(~held), "text", "lang")
    assert model.languages == other.languages and np.array_equal(model.centres, other.centres) and np.array_equal(model.idf, other.idf)


def test_odd_rows_rejection_and_nothing_learned(spark):
    rng = random.Random(8)
    say = lambda words: " ".join(rng.choice(words) for _ in range(60))
    english, french = "the of and to in is that it was for".split(), "le de et la les des en un du une".split()
    train = spark.createDataFrame([(say(english), "en") for _ in range(40)] + [(say(french), "fr") for _ in range(40)] + [(None, "xx"), ("12", "yy"), ("text", None)], "text string, lang string")
    model = langid.fit_languages(train, "text", "lang")
    assert set(model.languages) == {"en", "fr"}
    df = odd_documents(spark, [say(english), say(french), "漢字 かな 交じり", "42"])
    found = {r["doc_id"]: r for r in langid.predict_languages(spark, df.drop("score"), "doc_id", "text", model, F.col("n_chars")).collect()}
    assert (found[100]["language"], found[101]["language"]) == ("en", "fr")
    assert found[102]["language"] == "und" and found[102]["rejected"] and found[102]["nearest"] in ("en", "fr")
    assert all((found[i]["nearest"], found[i]["score"], found[i]["language"]) == ("und", 0.0, "und") for i in (2, 3, 4, 103))
    assert langid.predict_languages(spark, df, "doc_id", "text", model).count() == df.count()
    assert langid.predict_languages(spark, without_rows(df), "doc_id", "text", model).count() == 0
    empty = langid.fit_languages(without_rows(train), "text", "lang")
    assert {r["nearest"] for r in langid.predict_languages(spark, df, "doc_id", "text", empty).collect()} == {"und"}


def test_clusters_are_unit_centroids_of_their_members():
    rng = np.random.default_rng(3)
    groups = [np.abs(rng.normal(0, 0.01, (50, 30))) + np.eye(30)[i] for i in (0, 10, 20)]
    vectors = np.concatenate(groups)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, inside = langid.cluster(vectors, 3)
    assert sorted(centres.argmax(axis=1).tolist()) == [0, 10, 20]
    assert np.allclose(np.linalg.norm(centres, axis=1), 1) and (inside > 0.9).all() and math.isclose(langid.cluster(vectors[:1], 3)[1][0], 1, abs_tol=1e-6)
