"""The stored dense index against scoring every vector."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import retrieval
from lexmill.sources import vectors


def rows_of(hits):
    return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 8)) for r in hits.collect())


def grouped_vectors(spark, n=900, dim=16):
    """Vectors around 12 directions, a third of them one and the same vector, and a null."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, dim))
    points = centres[rng.integers(0, 12, n)] + 0.05 * rng.normal(size=(n, dim))
    points[: n // 3] = points[0]
    rows = [(i, f"n{i}", p.tolist()) for i, p in enumerate(points / np.linalg.norm(points, axis=1, keepdims=True))]
    df = spark.createDataFrame([*rows, (n, "null", None)], "doc_id long, name string, embedding array<float>").repartition(4)
    return df, centres


@pytest.mark.parametrize("max_queries", [4096, 5])
def test_hits_equal_scoring_everything_and_clusters_are_passed_over(spark, tmp_path, max_queries):
    df, centres = grouped_vectors(spark)
    asked = [(i, c.tolist()) for i, c in enumerate(centres)] + [(20, [0.0] * 16), (21, (3 * centres[0] - centres[1]).tolist())]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    path = str(tmp_path / "index")
    vectors.write_vectors(df, "doc_id", "embedding", path, clusters=14)
    index = vectors.load_vectors(spark, path)
    assert index.vectors.count() == 900 and set(df.columns) < set(index.vectors.columns)
    plain = df.where("embedding is not null")
    found = vectors.search_vectors(queries, index, 4, probes=2, max_queries=max_queries)
    assert rows_of(found.hits) == rows_of(retrieval.dense_topk(queries, plain, 4))
    share = found.scored.where("query_id < 12").agg(F.sum("scored") / F.sum("vectors")).first()[0]
    assert share < 0.7 and found.scored.count() == 14
    keep = F.col("doc_id") % 3 == 0
    filtered = vectors.search_vectors(queries, index, 4, keep, probes=2, max_queries=max_queries)
    assert rows_of(filtered.hits) == rows_of(retrieval.dense_topk(queries, plain, 4, "pre", keep))


def test_no_vectors_no_queries_and_fewer_than_k(spark, tmp_path):
    df, centres = grouped_vectors(spark, 9)
    queries = spark.createDataFrame([("a", centres[0].tolist()), ("none", None)], "query_id string, embedding array<double>")
    vectors.write_vectors(df.where("false"), "doc_id", "embedding", str(tmp_path / "empty"))
    assert vectors.search_vectors(queries, vectors.load_vectors(spark, str(tmp_path / "empty")), 3).hits.count() == 0
    vectors.write_vectors(df, "doc_id", "embedding", str(tmp_path / "few"))
    few = vectors.load_vectors(spark, str(tmp_path / "few"))
    assert vectors.search_vectors(queries, few, 20).hits.count() == 9
    assert vectors.search_vectors(queries.where("false"), few, 3).hits.count() == 0
