"""Language of texts by the nearest of several centroids per language, over TF-IDF vectors of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm.common import kept_by_worker, query, table
from lexmill.session import stage

#: Places that n-grams of one to three characters are hashed into.
DIM = 1 << 14
#: Different texts of each language that its centroids are fitted on at most: those with the smallest hash.
TRAIN_TEXTS = 1_000
#: Centroids of a language, and rounds of k-means.
CENTROIDS, ROUNDS = 3, 12
#: Share of a centroid's training texts that lie farther from it than its radius.
OUTSIDE = 0.01
UNKNOWN = "und"
_CHUNK = 1 << 20
_SPACE = 32
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_SHIFT = np.uint32(32 - DIM.bit_length() + 1)


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return kept_by_worker("letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def _places(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashed place of every n-gram of a sequence of code points."""
    mixed = codes[:len(codes) - n + 1] * _FACTORS[0]
    for k in range(1, n):
        mixed = ((mixed ^ (mixed >> np.uint32(15))) + codes[k:len(codes) - n + 1 + k]) * _FACTORS[k]
    return ((mixed ^ (mixed >> np.uint32(16))) * _FACTORS[n - 1] + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) >> _SHIFT


def ngram_counts(text: str) -> np.ndarray | None:
    """How often each place is met in a whole text; None if it has no letter.

    Letters are lower-cased; whatever stands between words counts as one space, as do both
    ends. A long text is counted in pieces that overlap by two characters.
    """
    letters, counts, seen = _letters(), np.zeros(DIM, np.int64), False
    text, tail = text.lower(), np.array([_SPACE], np.uint32)
    for at in range(0, max(1, len(text)), _CHUNK):
        codes = np.frombuffer(text[at:at + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        known = letters[codes]
        seen = seen or bool(known.any())
        codes = np.where(known, codes, np.uint32(_SPACE))
        if at + _CHUNK >= len(text):
            codes = np.append(codes, np.uint32(_SPACE))
        before = np.concatenate((tail[-1:], codes[:-1])) if len(codes) else codes
        codes = codes[(codes != _SPACE) | (before != _SPACE)]
        whole = np.concatenate((tail, codes))
        for n, part in ((1, codes), (2, whole[max(0, len(tail) - 1):]), (3, whole)):
            if len(part) >= n:
                counts += np.bincount(_places(part, n), minlength=DIM)
        tail = whole[-2:]
    return counts if seen else None


def _weighed(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the unit TF-IDF vector of a text."""
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at]) * idf[at]
    return at, value / np.sqrt(value @ value)


def _document_frequency(train: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each place is met, and the number of texts with a letter. Tasks count, and only DIM sums come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                counts = ngram_counts(value.as_py())
                if counts is not None:
                    met += counts > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIM)), pa.array(np.r_[n, met])], ["place", "n"])

    sums = train.select(F.col(text)).mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).where("n > 0")
    met = np.zeros(DIM + 1, np.int64)
    for row in sums.collect():
        met[row["place"] + 1] = row["n"]
    return met[1:], int(met[0])


def cluster(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit vectors by spherical k-means, and the smallest cosine that lies inside each one's radius."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(vectors)))]
    while len(chosen) < min(k, len(vectors)):
        away = np.clip(1.0 - (vectors @ vectors[chosen].T).max(axis=1).astype(np.float64), 0.0, None) ** 2
        if away.sum() <= 1e-12:
            break
        chosen.append(int(rng.choice(len(vectors), p=away / away.sum())))
    centres = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        moved = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        if np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    near = vectors @ centres.T
    own = near.argmax(axis=1)
    inside = np.array([np.quantile(near[own == j, j], OUTSIDE) if (own == j).any() else 1.0 for j in range(len(centres))])
    return centres, inside


class Model(NamedTuple):
    """idf by place; languages, vectors (place x centroid) and least inner cosine of the centroids."""

    idf: np.ndarray
    languages: list[str]
    centres: np.ndarray
    inside: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Nearest language, cosine to its nearest centroid, and whether the text lies outside that one's radius."""
        counts = ngram_counts(text) if text else None
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, True
        at, value = _weighed(counts, self.idf)
        near = value @ self.centres[at]
        best = int(near.argmax())
        return self.languages[best], float(min(max(near[best], 0.0), 1.0)), bool(near[best] < self.inside[best])


def fit_languages(train: DataFrame, text: str, language: str, train_texts: int = TRAIN_TEXTS, centroids: int = CENTROIDS) -> Model:
    """Learns from rows with a text and a language; others are passed over.

    Document frequencies cover every row. The centroids of a language come from `train_texts` of its different
    texts, those with the smallest hash, clustered in a task of its own; a language without letters has none.
    The model has languages x centroids x DIM numbers and is all that comes to the driver.
    """
    known = train.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(F.col(text).alias("text"), F.col(language).cast("string").alias("language"))
    met, n = _document_frequency(known, "text")
    idf = np.log((1 + n) / (1 + met)) + 1.0
    keyed = known.withColumn("key", F.shiftrightunsigned(F.xxhash64("text"), 11))
    once = stage(keyed.select("language", "key").distinct(), "text-keys")
    # Hashes are spread evenly, so about 2 * train_texts of a language lie below this share of their range, however many it has.
    share = once.groupBy("language").agg((2.0 * train_texts / F.count(F.lit(1))).alias("share"))
    # One row per language: smaller than the model, which has several centroids of each.
    small = once.join(F.broadcast(share), "language").where(F.col("key") < F.col("share") * float(1 << 53))
    place = F.row_number().over(Window.partitionBy("language").orderBy("key"))
    chosen = stage(small.withColumn("place", place).where(F.col("place") <= train_texts).select("language", "key"), "train-texts")
    sample = keyed.join(chosen, ["language", "key"]).dropDuplicates(["language", "key"])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        found = [c for c in map(ngram_counts, frame.sort_values("key")["text"]) if c is not None]
        if not found:
            return pd.DataFrame({"language": [], "centre": [], "inside": []}, dtype=object)
        vectors = np.zeros((len(found), DIM), np.float32)
        for row, counts in zip(vectors, found):
            at, value = _weighed(counts, idf)
            row[at] = value
        centres, inside = cluster(vectors, centroids)
        return pd.DataFrame({"language": frame["language"].iloc[0], "centre": list(centres.astype(np.float32)), "inside": inside})

    made = sample.groupBy("language").applyInPandas(fit, "language string, centre array<float>, inside double").collect()
    made.sort(key=lambda r: (r["language"], r["inside"], r["centre"]))
    centres = np.array([r["centre"] for r in made], np.float32).reshape(-1, DIM).T
    return Model(idf, [r["language"] for r in made], np.ascontiguousarray(centres), np.array([r["inside"] for r in made]))


def predict_languages(spark: SparkSession, df: DataFrame, id: str, text: str, model: Model, *more: Column) -> DataFrame:
    """id, columns `more`, nearest, score, rejected, language for every row of `df`, from the whole text alone.

    nearest is the language of the nearest centroid and score its cosine; rejected says that the text
    lies outside that centroid's radius; language is nearest, or `und` if rejected. A text that is null or
    has no letter has nearest `und` and score 0, as has every text where nothing was learned. Rows are judged each by itself.
    """
    shared = spark.sparkContext.broadcast(model)
    plain = df.select(F.col(text).alias("_text"), F.col(id).alias("_id"), *more)
    kept = plain.columns[1:]
    schema = ", ".join(f"c{i} {plain.schema[c].dataType.simpleString()}" for i, c in enumerate(kept))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(v.as_py()) for v in batch.column(0)]
            made = [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.float64(), pa.bool_()))] if found else [pa.array([], t) for t in (pa.string(), pa.float64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], [*[f"c{i}" for i in range(len(kept))], "nearest", "score", "rejected"])

    out = plain.mapInArrow(judge, f"{schema}, nearest string, score double, rejected boolean")
    named = out.select(F.col("c0").alias(id), *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept) if i], "nearest", "score", "rejected")
    return named.withColumn("language", F.when(F.col("rejected"), UNKNOWN).otherwise(F.col("nearest")))


def held_out(id: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of its id mod 4 is 2. A null id is not."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op13_language_id")
def op13_language_id(spark, sf):
    """Nearest language of every document; three quarters of them were learned from."""
    docs = table(spark, sf, "documents")
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))), "text", "lang")
    found = predict_languages(spark, docs, "doc_id", "text", model, held_out(F.col("doc_id")).alias("held_out"))
    return found.select("doc_id", "held_out", F.col("nearest").alias("lang_pred"), "score", "rejected")
