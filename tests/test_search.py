"""Search and metrics against brute force and hand-made cases."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.operators import irmetrics, retrieval

WORDS = ["ley", "norma", "salud", "agua", "minas", "pesca", "trabajo", "de", "la"]


def corpus(seed=1, n=80):
    rnd = random.Random(seed)
    docs = [(i, "de " + " ".join(rnd.choices(WORDS, k=rnd.randrange(0, 12)))) for i in range(n)] + [(n, ""), (n + 1, None)]
    queries = [(j, " ".join(rnd.choices(WORDS + ["otra"], k=4))) for j in range(9)]
    return docs, queries


def brute_bm25(docs, queries, k, k1=1.5, b=0.75, eps=0.25):
    bags = {i: Counter((t or "").lower().split()) for i, t in docs}
    sizes = {i: sum(c.values()) for i, c in bags.items()}
    avg = sum(sizes.values()) / len(bags)
    df = Counter(w for c in bags.values() for w in c)
    idf = {w: math.log(len(bags) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: v if v >= 0 else eps * mean for w, v in idf.items()}
    out = []
    for j, q in queries:
        scores = []
        for i, bag in bags.items():
            s = sum(idf[w] * bag[w] * (k1 + 1) / (bag[w] + k1 * (1 - b + b * sizes[i] / avg)) for w in q.split() if w in bag)
            if round(s, 9) > 0:
                scores.append((-round(s, 9), i))
        out += [(j, i, r, round(-s, 6)) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("max_rows", [200_000, 7])
def test_bm25(spark, max_rows):
    """The second bound forces the query set into several blocks."""
    docs, queries = corpus()
    d, q = spark.createDataFrame(docs, "id long, t string"), spark.createDataFrame(queries, "query_id long, query string")
    hits = retrieval.bm25_topk(q, retrieval.bm25_index(d, "id", "t"), 5, max_rows=max_rows)
    got = sorted((r["query_id"], r["doc_id"], r["rank"], round(r["score"], 6)) for r in hits.collect())
    assert got == brute_bm25(docs, queries, 5)


def vectors(n, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[n // 2] = v[0]  # equal vectors tie
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def frames(spark, n_docs=300, n_queries=11):
    d, q = vectors(n_docs), vectors(n_queries, seed=4)
    docs = spark.createDataFrame([(i, [float(x) for x in v], i % 3) for i, v in enumerate(d)], "doc_id long, embedding array<float>, label int")
    queries = spark.createDataFrame([(j, [float(x) for x in v]) for j, v in enumerate(q)], "query_id long, embedding array<float>")
    scores = np.round(q.astype(np.float64) @ d.astype(np.float64).T, 9)
    return docs, queries, scores


def brute_dense(scores, k, keep=lambda i: True, wide=None):
    out = []
    for j, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda i: (-row[i], i))[:wide]
        out += [(j, i, r) for r, i in enumerate([i for i in order if keep(i)][:k], 1)]
    return sorted(out)


def hits_of(df):
    return sorted((r["query_id"], r["doc_id"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("max_queries", [4096, 4])
@pytest.mark.parametrize("partitions", [1, 5])
def test_dense(spark, max_queries, partitions):
    docs, queries, scores = frames(spark)
    got = retrieval.dense_topk(queries, docs.repartition(partitions), 6, max_queries=max_queries)
    assert hits_of(got) == brute_dense(scores, 6)


def test_dense_filters(spark):
    docs, queries, scores = frames(spark)
    keep = F.col("label") == 1
    assert hits_of(retrieval.dense_topk(queries, docs, 2, "post", keep)) == brute_dense(scores, 2, lambda i: i % 3 == 1, wide=20)
    assert hits_of(retrieval.dense_topk(queries, docs, 2, "pre", keep)) == brute_dense(scores, 2, lambda i: i % 3 == 1)


def test_post_filter_may_come_back_empty(spark):
    docs, queries, _ = frames(spark)
    nothing = F.col("label") == 99
    assert retrieval.dense_topk(queries, docs, 2, "post", nothing).count() == 0
    assert retrieval.dense_topk(queries.limit(0), docs, 2).count() == 0


def test_blocks_need_not_fit_evenly(spark):
    docs, queries, scores = frames(spark)
    pairs = retrieval.pair_scores(queries, docs, 3, max_queries=2, block_rows=17)
    best = retrieval.rank_topk(pairs, "query_id", "score", "doc_id", 3)
    assert hits_of(best) == brute_dense(scores, 3)


def test_encoder_is_pluggable_and_unit_length(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id long, t string")
    rows = {r["id"]: r["embedding"] for r in retrieval.encode(df, "t", retrieval.hashed_terms_encoder(16)).collect()}
    assert abs(sum(x * x for x in rows[1]) - 1) < 1e-6 and not any(rows[2]) and not any(rows[3])
    own = retrieval.encode(df, "t", lambda texts: np.array([[len(t or ""), 1.0] for t in texts]))
    assert {r["id"]: r["embedding"] for r in own.collect()} == {1: [5.0, 1.0], 2: [0.0, 1.0], 3: [0.0, 1.0]}


# --- Metrics ----------------------------------------------------------------------

def judged(spark, rels, k=5):
    """One query, hits at ranks 1.. with the given relevance."""
    hits = spark.createDataFrame([("s", 1, i, r, "agua y sal" if r else "nada", "LEY") for i, r in enumerate(rels, 1)],
                                 "system string, query_id int, rank int, want int, title string, type string")
    queries = spark.createDataFrame([(1, ["AGUA", "sal", "minas", "pesca"]), (2, ["x"])], "query_id int, keywords array<string>")
    return irmetrics.judge(hits, queries), queries


@pytest.mark.parametrize("rels, precision, mrr, ndcg", [
    ([1, 1], 0.4, 1.0, 1.0),
    ([0, 0, 1], 0.2, 1 / 3, 1 / math.log2(4)),
    ([1], 0.2, 1.0, 1.0),
    ([0, 1], 0.2, 0.5, 0.63093),
    ([0, 0], 0.0, 0.0, 0.0),
    ([1, 0, 1, 0, 1, 1], 0.6, 1.0, (1 + 1 / 2 + 1 / math.log2(6)) / (1 + 1 / math.log2(3) + 1 / 2)),
])
def test_metrics(spark, rels, precision, mrr, ndcg):
    hits, queries = judged(spark, rels)
    for df, name, value in (
        (irmetrics.precision_at_k(hits, queries, 5, ["s"]), "precision", precision),
        (irmetrics.mrr_at_k(hits, queries, 5, ["s"]), "mrr", mrr),
        (irmetrics.ndcg_at_k(hits, queries, 5, ["s"]), "ndcg", ndcg),
        (irmetrics.keyword_recall_at_k(hits, queries, 5, ["s"]), "keyword_recall", 0.5 if any(rels[:5]) else 0.0),
    ):
        got = {r["query_id"]: r[name] for r in df.collect()}
        assert got[1] == pytest.approx(value, abs=1e-5) and got[2] == 0.0


def test_relevance_looks_at_type_but_recall_does_not(spark):
    hits = spark.createDataFrame([("s", 1, 1, "nada", "LEY ORGANICA")], "system string, query_id int, rank int, title string, type string")
    queries = spark.createDataFrame([(1, ["organica"])], "query_id int, keywords array<string>")
    assert irmetrics.judge(hits, queries).first()["rel"] == 1
    assert irmetrics.keyword_recall_at_k(irmetrics.judge(hits, queries), queries, 5, ["s"]).first()["keyword_recall"] == 0


def test_evaluation_stays_between_zero_and_one(spark):
    queries = irmetrics.evaluation_queries(spark)
    assert queries.count() == 12
    titles = spark.createDataFrame([(i, f"{w} {i}", "LEY") for i, w in enumerate(["salud pública", "contrato de trabajo", "renta", "mujer"] * 5)], "doc_id long, title string, type string")
    index = retrieval.bm25_index(titles, "doc_id", "title")
    lexical = retrieval.bm25_topk(queries, index, 5).join(titles, "doc_id")
    enc = retrieval.hashed_terms_encoder(64)
    dense = retrieval.dense_topk(retrieval.encode(queries.select("query_id", "query"), "query", enc),
                                 retrieval.encode(titles.select("doc_id", "title"), "title", enc), 5).join(titles, "doc_id")
    table = irmetrics.evaluate(queries, {"dense": dense, "bm25": lexical}, 5).toPandas()
    assert len(table) == 24 and table[["precision", "keyword_recall", "mrr", "ndcg"]].apply(lambda c: c.between(0, 1)).all().all()
    means = irmetrics.mean_metrics(spark.createDataFrame(table), "dense", "bm25").toPandas().set_index("metric")
    assert means.loc["mrr", "gain"] == pytest.approx(table[table.system == "dense"].mrr.mean() - table[table.system == "bm25"].mrr.mean())
    assert isinstance(means, pd.DataFrame)


def test_scoring_tasks_follow_the_documents(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "SCORED_DOCS", 10)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("norma").alias("text"))
    assert retrieval.bm25_postings(retrieval.counted_documents(docs, "doc_id", "text")).rdd.getNumPartitions() == 40


def test_encoder_gets_texts_batch_by_batch(spark):
    """Each batch comes as strings of its own, not as a part of a frame that holds all texts of an Arrow batch."""

    def first_index(texts):
        return np.array([[float(texts.index[0]), float(len(texts)), float(sum(t is None for t in texts))]] * len(texts))

    docs = spark.range(0, 100, 1, 1).select("id", F.when(F.col("id") != 7, F.lit("a b")).alias("text"), F.current_date().alias("day"))
    rows = retrieval.encode(docs, "text", first_index, batch=32).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(100)) and all(r["day"] is not None for r in rows)
    assert {tuple(r["embedding"]) for r in rows} == {(0.0, 32.0, 1.0), (0.0, 32.0, 0.0), (0.0, 4.0, 0.0)}
