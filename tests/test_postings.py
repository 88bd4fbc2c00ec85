"""The stored lexical index against scoring every document."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill import jobs
from lexmill.operators import retrieval
from lexmill.sources import postings


def rows_of(hits):
    return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 8)) for r in hits.collect())


@pytest.mark.parametrize("max_rows", [200_000, 5])
def test_hits_equal_scoring_everything_and_blocks_are_passed_over(spark, tmp_path, max_rows):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(120)]
    say = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(120)], k=n))
    texts = [say(rng.randint(1, 40)) for _ in range(400)] + ["w90 w91 w92"] * 30 + ["", None, "w119 " * 50]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(5)
    queries = spark.createDataFrame([(i, say(3)) for i in range(12)] + [(20, "w90 w91"), (21, "nowhere"), (22, ""), (23, "w119 w119 w0"), (24, say(60))], "query_id long, query string")
    postings.write_bm25(docs, "id", "text", str(tmp_path / "index"), block_docs=8, parts=3)
    index = postings.load_bm25(spark, str(tmp_path / "index"))
    found = postings.search_stored(queries, index, 4, probes=3, max_rows=max_rows)
    plain = retrieval.bm25_index(docs, "id", "text")
    assert rows_of(found.hits) == rows_of(retrieval.bm25_topk(queries, plain, 4))
    short = F.col("query_id") < 12
    assert found.scored.where(short).count() < 0.6 * found.bounds.where(short).count()
    keep = docs.where("id % 3 = 0").select(F.col("id").alias("doc_id"))
    assert rows_of(postings.search_stored(queries, index, 4, keep=keep).hits) == rows_of(retrieval.bm25_topk(queries, plain, 4, keep=keep))


def test_no_rows_and_the_job(spark, tmp_path):
    index = spark.createDataFrame([(1, "ley de aguas", True), (2, "ley de minas", False), (3, "ley de aguas y minas", None), *[(i, f"otra norma {i}", True) for i in range(4, 12)]], "norm_id long, title string, is_valid boolean").withColumn("embedding", F.lit(None))
    queries = spark.createDataFrame([(1, "aguas"), (2, "minas")], "query_id long, query string")
    path = str(tmp_path / "index")
    postings.write_bm25(index, "norm_id", "title", path)
    a, b = (sorted(map(tuple, jobs.search_bm25(index, queries, 2, stored=s).select("query_id", "rank", "doc_id", "title").collect())) for s in (path, None))
    assert a == b and a
    postings.write_bm25(index.where("false"), "norm_id", "title", str(tmp_path / "empty"))
    assert postings.search_stored(queries, postings.load_bm25(spark, str(tmp_path / "empty")), 2).hits.count() == 0


def test_what_queries_make_of_the_index_does_not_move(spark, tmp_path):
    """Postings move by block; neither terms of chosen blocks nor scores of single documents do."""
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 11} w{i % 3}") for i in range(300)], "id long, text string")
    queries = spark.createDataFrame([(1, "w1 w2 w8"), (2, "w0 w5")], "query_id long, query string")
    postings.write_bm25(docs, "id", "text", str(tmp_path / "index"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        keep = docs.where("id % 2 = 0").select(F.col("id").cast("int").alias("doc_id"))
        hits = postings.search_stored(queries, postings.load_bm25(spark, str(tmp_path / "index")), 3, keep=keep).hits
        plan = hits._jdf.queryExecution().executedPlan().toString()
        moves = re.findall(r"hashpartitioning\((.*?)\)", plan)
        assert any(m.startswith("block") for m in moves) and not any("term" in m and "block" in m or "doc_id" in m for m in moves)
        assert rows_of(hits) == rows_of(retrieval.bm25_topk(queries, retrieval.bm25_index(docs, "id", "text"), 3, keep=keep))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
