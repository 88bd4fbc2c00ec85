"""Documents to token ids in four stages, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import table
from lexmill.llm.decontaminate import drop_contaminated
from lexmill.llm.pieces import encode_texts
from lexmill.llm.quality import keep_good
from lexmill.llm.similar import keep_one_of_similar
from lexmill.session import stage

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own evidence and site speak for quality."""
    return keep_good(docs, "doc_id", "text", F.col("source"), F.col("lang"), table(spark, sf_dir, "labels"), "quality")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingle sets of similarity 0.8 or more."""
    return keep_one_of_similar(docs, "doc_id", "text")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten benchmark words."""
    return drop_contaminated(docs, "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, score, nbest, round_trip of what is left."""
    # Workers still hold memory of the stages before, so they keep fewer words.
    return encode_texts(docs.select("doc_id", "text"), "text", PIECES, cache=200_000).drop("text")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]
#: The classifier and the search for segmentations have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage without rows passes an empty table on."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, f"pipeline-{number}")
    return docs
