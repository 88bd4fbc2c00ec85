"""The pipeline against its stages done plainly."""

from llm_fixtures import odd_documents
from pyspark.sql import functions as F
from test_similar import plain_components
from test_texts import plain_hits

import corpus_pipeline
from lexmill.llm import quality


def test_run_equals_plain_stages(spark, sf_dir):
    docs, labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    judged = quality.judge_quality(docs, "doc_id", "text", F.col("source"), F.col("lang"), labels, "quality")
    good = {r["id"] for r in judged.where("keep").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    single = {d for d, c in plain_components(texts).items() if d == c}
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    left = {d for d in single if not plain_hits(texts[d], items)[-1]}
    assert len(left) < len(single) < len(good)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == left and len(rows) == len(left) and all(r["round_trip"] for r in rows)


def test_stages_bear_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, sf_dir)
        assert out.count() == 0, name


def test_stages_bear_odd_rows_in_turn(spark, sf_dir):
    """Nulls, repeats, very long texts and clashing columns go through all stages; each keeps the columns but for the last."""
    docs = odd_documents(spark, ["some plain words stand here", "some plain words stand here"])
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count(), name
        docs = out
    name, function = corpus_pipeline.STAGES[-1]
    assert all(r["round_trip"] for r in function(spark, docs, sf_dir).collect())
