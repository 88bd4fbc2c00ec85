"""A BM25 index that is built once and kept: posting blocks with their greatest weight, and exact search that passes over blocks.

Documents are dealt to blocks by a hash of their id. A row of `path`/blocks is a term in a block: its
greatest weight there and its postings. The sum of these weights over the terms of a query bounds every score in a
block, so blocks that cannot enter the first k are never scored. `path`/terms and `path`/stats hold what weighs a query.
"""

from __future__ import annotations

import json
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill import fixed
from lexmill.operators.retrieval import SCORE_DIGITS, SCORED_DOCS, counted_documents, counted_index, positive, query_terms, rank_topk
from lexmill.operators.skew import BROADCAST_ROWS
from lexmill.session import read_text, stage, write_text

#: Documents of a block, on average.
BLOCK_DOCS = 16
#: Blocks of a query that are scored first, those with the greatest bounds.
PROBES = 8
#: What rounding may take from a bound.
SLACK = 1e-6


class Stored(NamedTuple):
    """blocks (part, term, block, top, postings of doc_id and weight), terms (term, df, idf), stats (one row: n, avgdl, mean_idf, n_terms)."""

    blocks: DataFrame
    terms: DataFrame
    stats: DataFrame


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def _block(id: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(id), F.lit(n_blocks))


def write_bm25(df: DataFrame, id: str, text: str, path: str, block_docs: int = BLOCK_DOCS, parts: int = 16) -> None:
    """Builds the index of all rows and stores it; blocks lie by hash of their term in `parts` folders, sorted by term and block.

    A weight is what a posting adds to a score for each unit of the query's weight. Postings of a term are put together
    within a block only, so a term that every document has gives short rows in every block and no long one. Each task writes
    a file of its blocks to each folder.
    """
    counted = counted_documents(df, id, text)
    index = counted_index(counted)
    stats = stage(index.stats, "bm25-stats")
    n, avgdl = stats.select("n", "avgdl").first()
    n_blocks = max(1, -(-n // block_docs))
    k1, b = fixed.BM25_K1, fixed.BM25_B
    weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.lit(avgdl or 1.0)))
    # Counts of whole documents move once, by block; what is made of them stays in the task.
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, ceil(n / SCORED_DOCS))
    rows = counted.withColumn("block", _block(F.col("doc_id"), n_blocks)).repartition(tasks, "block")
    found = rows.select("block", "doc_id", "dl", F.explode("terms").alias("t")).select("block", "doc_id", "dl", "t.term", "t.tf")
    weighed = found.select("block", "term", F.struct("doc_id", weight.alias("weight")).alias("p"))
    blocks = weighed.groupBy("block", "term").agg(F.max("p.weight").alias("top"), F.collect_list("p").alias("postings"))
    dealt = blocks.withColumn("part", _part(F.col("term"), parts)).sortWithinPartitions("part", "term", "block")
    dealt.write.mode("overwrite").partitionBy("part").parquet(f"{path}/blocks")
    write_text(df.sparkSession, f"{path}/schema", dealt.schema.json())
    index.terms.write.mode("overwrite").parquet(f"{path}/terms")
    stats.withColumns({"parts": F.lit(parts), "n_blocks": F.lit(n_blocks)}).write.mode("overwrite").parquet(f"{path}/stats")


def load_bm25(spark: SparkSession, path: str) -> Stored:
    """The stored index; an index of no rows has no blocks."""
    schema = T.StructType.fromJson(json.loads(read_text(spark, f"{path}/schema")))
    return Stored(spark.read.schema(schema).parquet(f"{path}/blocks"), *(spark.read.parquet(f"{path}/{name}") for name in ("terms", "stats")))


def _gathered(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


class Hits(NamedTuple):
    """hits (query_id, doc_id, score, rank); bounds of the blocks that hold a query's term (query_id, block, bound), and those that were scored."""

    hits: DataFrame
    bounds: DataFrame
    scored: DataFrame


def search_stored(queries: DataFrame, index: Stored, k: int, query_id: str = "query_id", text: str = "query", keep: DataFrame | None = None,
                  probes: int = PROBES, max_rows: int = BROADCAST_ROWS) -> Hits:
    """The exact top k positive scores per query, as `bm25_topk` gives them.

    First the bound of each block is summed for each query from terms and greatest weights alone; postings are not
    read for that. The blocks with the greatest bounds are scored; the k-th best score found there (of documents in `keep`,
    if given) is one that a better document must reach, so of the other blocks only those are scored
    whose bound does. Where a query has fewer than k hits so far, all its blocks are scored.
    """
    parts, n_blocks = index.stats.select("parts", "n_blocks").first()
    weights = stage(query_terms(queries, query_id, text).join(index.terms.select("term", "idf"), "term").withColumn("part", _part(F.col("term"), parts)), "weights")
    wanted = [r[0] for r in weights.select("part").distinct().collect()]
    blocks = index.blocks.where(F.col("part").isin(*wanted))
    n_frames = max(1, ceil(weights.count() / max_rows))
    of_frame = lambda df, b: df.where(F.pmod(F.xxhash64("query_id"), F.lit(n_frames)) == b)
    frames = [(b, of_frame(weights, b).drop("part")) for b in range(n_frames)]
    asked = lambda rows, w: rows.join(F.broadcast(w.select("term").distinct()), "term", "left_semi")
    most = F.greatest(F.col("qtf") * F.col("idf") * F.col("top"), F.lit(0.0))
    # Rows of the index move by block before they meet queries: what they become by query is summed in the task.
    bounded = [asked(blocks.select("term", "block", "top"), w).repartition("block").join(F.broadcast(w), "term").groupBy("block", "query_id").agg(F.sum(most).alias("bound")) for _, w in frames]
    bounds = stage(_gathered(bounded).select("query_id", "block", "bound"), "bounds")
    kept = None
    if keep is not None:
        id_type = blocks.schema["postings"].dataType.elementType["doc_id"].dataType
        ids = keep.select(F.col("doc_id").cast(id_type).alias("doc_id"))
        kept = ids.groupBy(_block(F.col("doc_id"), n_blocks).alias("block")).agg(F.collect_set("doc_id").alias("_kept"))

    def score(chosen: DataFrame) -> DataFrame:
        scored = []
        for b, w in frames:
            by_block = of_frame(chosen, b).groupBy("block").agg(F.collect_set("query_id").alias("_asked"))
            by_block = by_block if kept is None else by_block.join(kept, "block")
            rows = asked(blocks.select("term", "block", "postings"), w).join(by_block.hint("shuffle_hash"), "block")
            found = F.col("postings") if kept is None else F.filter("postings", lambda p: F.array_contains("_kept", p["doc_id"]))
            met = rows.withColumn("postings", found).join(F.broadcast(w), "term").where(F.array_contains("_asked", F.col("query_id")))
            each = met.select("block", "query_id", "qtf", "idf", F.explode("postings").alias("p"))
            scored.append(each.groupBy("block", "query_id", F.col("p.doc_id").alias("doc_id")).agg(F.round(F.sum(F.col("qtf") * F.col("idf") * F.col("p.weight")), SCORE_DIGITS).alias("score")))
        return rank_topk(positive(_gathered(scored).drop("block")), "query_id", "score", "doc_id", k)

    first = stage(rank_topk(bounds, "query_id", "bound", "block", probes).select("query_id", "block", "bound"), "probes")
    best = stage(score(first), "first-hits")
    reach = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("reach"))
    able = bounds.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti").join(reach, "query_id", "left")
    rest = stage(able.where((F.col("bound") > 0) & (F.col("bound") + SLACK >= F.coalesce("reach", F.lit(0.0)))).select("query_id", "block", "bound"), "rest")
    both = best.drop("rank").unionByName(score(rest).drop("rank"))
    hits = rank_topk(both, "query_id", "score", "doc_id", k).select("query_id", "doc_id", "score", "rank")
    return Hits(hits, bounds, first.unionByName(rest))
