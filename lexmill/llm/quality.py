"""Document quality by a classifier and its site: hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import query, table, text_key, without
from lexmill.session import stage

FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "pipes", "stops", "beyond_ascii",
            "same_as_last", "distinct", "shouted", "marked", "lines_again")
#: Labelled rows that a classifier is fitted on at most: those with the smallest hash of their id.
TRAIN_ROWS = 20_000
#: Weight of the site's odds beside those of the document itself.
SITE_WEIGHT = 0.5
_PLAIN_MARKS = b".,;:!?'\"()-"
_CLASSES = np.array([
    [65 <= b <= 90 for b in range(256)],
    [48 <= b <= 57 for b in range(256)],
    [33 <= b <= 126 and not chr(b).isalnum() and b not in _PLAIN_MARKS for b in range(256)],
    [b == ord("|") for b in range(256)],
    [b in b".!?" for b in range(256)],
    [b >= 128 for b in range(256)],
], np.int64)


def features(text: bytes) -> list[float]:
    """Shares that tell running prose from junk, over the whole UTF-8 text; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    solid = sum(map(len, words))
    counts = _CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [line for line in text.split(b"\n") if line]
    return [
        math.log1p(n), min(solid / n, 50.0), *(counts / solid).tolist(),
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(words)) / n ** 0.75,
        sum(w[:2].isupper() for w in words) / n,
        sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in b".,;:?" for w in words) / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]


def with_features(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns `keep` and x (array of `FEATURES`) for every row."""
    fields = ", ".join(f"`c{i}` {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            x = pa.array((features(t.as_py() or b"") for t in texts), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], x], [*[f"c{i}" for i in range(len(keep))], "x"])

    slim = df.select(F.col(text).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    out = slim.mapInArrow(measure, f"{fields}{', ' if keep else ''}x array<double>")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "x")


class Classifier(NamedTuple):
    """Logistic model on `FEATURES`: P(good) = 1 / (1 + exp(-(intercept + weights . x)))."""

    weights: list[float]
    intercept: float

    def score(self, x: Column) -> Column:
        terms = [x[i] * F.lit(w) for i, w in enumerate(self.weights)]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-sum(terms, F.lit(self.intercept))))


def fit_classifier(measured: DataFrame, labels: DataFrame, id: str, label: str, train_rows: int = TRAIN_ROWS) -> Classifier:
    """A logistic regression on at most `train_rows` labelled rows of `measured` (id, x); label is 1 for good, 0 for bad.

    The sample is the labelled ids with the smallest hash. Rows without id or
    label are passed over. With labels of one class only, or none, every document
    gets the same score: the smoothed share of good labels.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(id).agg(F.max(label).alias("_label"))
    chosen = stage(known.orderBy(F.xxhash64(id), id).limit(train_rows), "train-ids")
    train = stage(measured.join(F.broadcast(chosen), id).select("x", F.col("_label").cast("double").alias("label")), "train")
    good, n = train.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count(F.lit(1))).first()
    if good in (0, n):
        return Classifier([0.0] * len(FEATURES), math.log((good + 1) / (n - good + 1)))
    vectors = train.select("label", array_to_vector("x").alias("features"))
    model = LogisticRegression(maxIter=60, regParam=0.001, aggregationDepth=2).fit(vectors)
    return Classifier(model.coefficients.toArray().tolist(), float(model.intercept))


def _strength(sites: DataFrame, mean: Column, spread: Column) -> float:
    """How many documents a prior counts for, by the method of moments.

    `sites` has one row per site with n documents and a sum s of their scores; `mean` is
    the prior mean of each site, `spread` the variance of one document around it.
    The variance between sites is what exceeds the noise of means of n documents.
    """
    n, away = F.col("n"), F.col("s") / F.col("n") - mean
    between, noise, weight, squares, v = sites.agg(
        F.sum(n * away * away), F.sum(spread), F.sum(n), F.sum(n * n), F.sum(n * spread)).first()
    if not weight:
        return 1.0
    variance = max((between - noise) / max(weight - squares / weight, 1.0), 1e-6)
    return min(max(v / weight / variance - 1.0, 1.0), 1e6)


def site_posteriors(scored: DataFrame, site_weight: float = SITE_WEIGHT) -> DataFrame:
    """Adds host_posterior, path_posterior and posterior to rows with p (score), host and path.

    Scores are summed per path and per host (partial sums first, so a hot host is
    only counters). Each host's share of good documents is shrunk to the global
    share, and each path's to its host's, by a prior whose strength is estimated
    from all hosts and all paths. A row's own score is left out of its site's, so
    it is not counted twice. posterior joins the odds of the document and those of
    its path against the global share.
    """
    paths = stage(scored.groupBy("host", "path").agg(F.count("p").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = stage(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "hosts")
    n, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = min(max((s or 0.0) / (n or 1), 1e-4), 1 - 1e-4) if n else 0.5
    # What one document's score varies within a site of mean m: at most m * (1 - m).
    k_host = _strength(hosts, F.lit(mean), F.lit(mean * (1 - mean)))
    at_host = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    shrunk = (F.lit(k_host * mean) + F.col("host_s")) / (k_host + F.col("host_n"))
    sites = paths.join(at_host, "host")
    k_path = _strength(sites, shrunk, shrunk * (1 - shrunk))
    sites = stage(sites.withColumnRenamed("n", "path_n").withColumnRenamed("s", "path_s"), "sites")
    host = (F.lit(k_host * mean) + F.col("host_s") - F.col("p")) / (k_host + F.col("host_n") - 1)
    path = (k_path * F.col("host_posterior") + F.col("path_s") - F.col("p")) / (k_path + F.col("path_n") - 1)

    def logit(c: Column) -> Column:
        c = F.least(F.greatest(c, F.lit(1e-9)), F.lit(1 - 1e-9))
        return F.log(c / (1 - c))

    odds = logit(F.col("p")) + site_weight * (logit(F.col("path_posterior")) - F.lit(math.log(mean / (1 - mean))))
    return (
        scored.join(sites, ["host", "path"]).withColumn("host_posterior", host).withColumn("path_posterior", path)
        .withColumn("posterior", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))
        .drop("path_n", "path_s", "host_n", "host_s")
    )


def judge_quality(docs: DataFrame, id: str, text: str, host: Column, path: Column, labels: DataFrame, label: str,
                  train_rows: int = TRAIN_ROWS, site_weight: float = SITE_WEIGHT, threshold: float = 0.5) -> DataFrame:
    """id, text_key, host, path, n_words, p, host_posterior, path_posterior, posterior, keep: one row for each row of `docs`.

    A document is kept if it has words and its posterior is `threshold` or more. Texts are
    read once, whole; what moves afterwards are scores and sites. Null host or path counts as
    empty, a null text as one without words; rows sharing an id are judged each
    by its own text. An empty table gives no rows.
    """
    keyed = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), text_key(id, text).alias("text_key"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    measured = stage(with_features(keyed, "text", ["id", "text_key", "host", "path"]), "features")
    model = fit_classifier(measured, labels.select(F.col(id).alias("id"), label), "id", label, train_rows)
    scored = measured.select("id", "text_key", "host", "path", F.round(F.exp(F.col("x")[0]) - 1).cast("long").alias("n_words"), model.score(F.col("x")).alias("p"))
    keep = (F.col("n_words") > 0) & (F.col("posterior") >= threshold)
    return site_posteriors(scored, site_weight).withColumn("keep", keep)


def keep_good(docs: DataFrame, id: str, text: str, host: Column, path: Column, labels: DataFrame, label: str) -> DataFrame:
    """Rows of `docs` that `judge_quality` keeps."""
    judged = judge_quality(docs, id, text, host, path, labels, label)
    return without(docs, stage(judged.where(~F.col("keep")).select("id", "text_key"), "rejected"), id, text)


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf):
    """Every document judged by its own text, its source (host) and its language there (path)."""
    judged = judge_quality(table(spark, sf, "documents"), "doc_id", "text", F.col("source"), F.col("lang"), table(spark, sf, "labels"), "quality")
    return judged.select(F.col("id").alias("doc_id"), "host", "path", "n_words", "p", "host_posterior", "path_posterior", "posterior", "keep")
