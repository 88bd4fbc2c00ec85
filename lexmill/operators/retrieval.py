"""Search: hashed-term encoder, exact dense top k, BM25."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.functions.tokens import term_counts, tokens_ws
from lexmill.operators.skew import BROADCAST_ROWS
from lexmill.session import stage

SCORE_DIGITS = 9
#: Documents of a task that scores.
SCORED_DOCS = 20_000


# --- Encoding -----------------------------------------------------------------

def hashed_terms_encoder(dim: int = 384) -> Callable[[pd.Series], np.ndarray]:
    """Default encoder: term counts hashed into `dim` places, unit length. Needs no model."""

    def encode_batch(texts: pd.Series) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        place: dict[str, int] = {}
        for row, text in enumerate(texts):
            for term in (text or "").lower().split():
                if term not in place:
                    place[term] = int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % dim
                out[row, place[term]] += 1.0
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms == 0, 1.0, norms)

    return encode_batch


def encode(df: DataFrame, text: str, encoder: Callable[[pd.Series], np.ndarray] | None = None, batch: int = 32,
           out: str = "embedding") -> DataFrame:
    """Unit vectors of `text` by any encoder of a batch of strings; other columns pass through."""
    run = encoder or hashed_terms_encoder()
    keep = [c for c in df.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def encode_batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            place = frame.schema.get_field_index(text)
            for start in range(0, frame.num_rows, batch):
                part = frame.slice(start, batch)
                vectors = np.asarray(run(part.column(place).to_pandas()), dtype=np.float32)
                ends = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), column], names=[*keep, out])

    # Texts stay in Arrow's form, and only those of one batch become Python strings.
    return df.select(*keep, text).mapInArrow(encode_batches, f"{schema}, {out} array<float>")


# --- Dense search -------------------------------------------------------------

def _local_topk(scores: np.ndarray, doc_ids: np.ndarray, query_ids: np.ndarray, k: int) -> pd.DataFrame:
    """Best k documents of one block for each query; ties by document id."""
    scores = np.round(scores, SCORE_DIGITS)
    place = np.unique(doc_ids, return_inverse=True)[1]
    parts = []
    for j, qid in enumerate(query_ids):
        column = scores[:, j]
        # Only rows at or above the k-th score are sorted, all ties with it among them.
        able = np.flatnonzero(column >= np.partition(column, -k)[-k]) if len(column) > k else np.arange(len(column))
        best = able[np.lexsort((place[able], -column[able]))[:k]]
        parts.append(pd.DataFrame({"query_id": qid, "doc_id": doc_ids[best], "score": scores[best, j]}))
    return pd.concat(parts, ignore_index=True)


def _pick_topk(hits: DataFrame, k: int) -> DataFrame:
    ranked = rank_topk(hits, "query_id", "score", "doc_id", k)
    return ranked.select("query_id", "doc_id", "score", "rank")


def rank_topk(df: DataFrame, query: str, score: str, id: str, k: int) -> DataFrame:
    """Rank within each query by score, ties by id, first k. The limit is applied before the shuffle."""
    w = Window.partitionBy(query).orderBy(F.desc(score), F.asc(id))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pair_scores(queries: DataFrame, index: DataFrame, k: int, query_id: str = "query_id", doc_id: str = "doc_id",
                vector: str = "embedding", max_queries: int = 4096, block_rows: int = 8192) -> DataFrame:
    """Inner products of every query with every vector, kept only where they can reach the top k.

    A query set counted to be small goes to every task as one matrix and the
    index is read in place. A larger one is cut into blocks that meet blocks of
    the index, so no task ever holds more than a block of each.
    """
    spark = index.sparkSession
    types = {c: dict(df.dtypes)[c] for df, c in ((queries, query_id), (index, doc_id))}
    schema = f"query_id {types[query_id]}, doc_id {types[doc_id]}, score double"
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("qv"))
    d = index.select(F.col(doc_id).alias("doc_id"), F.col(vector).alias("dv"))
    head = q.limit(max_queries + 1).toPandas()

    def score_block(docs: pd.DataFrame, ids: np.ndarray, matrix: np.ndarray) -> pd.DataFrame:
        vectors = np.stack(docs["dv"].to_numpy()).astype(np.float64)
        return _local_topk(vectors @ matrix.T, docs["doc_id"].to_numpy(), ids, k)

    if len(head) == 0:
        return spark.createDataFrame([], schema)
    if len(head) <= max_queries:
        shared = spark.sparkContext.broadcast((head["query_id"].to_numpy(), np.stack(head["qv"].to_numpy()).astype(np.float64)))

        def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, matrix = shared.value
            best = None
            for frame in frames:
                if len(frame):
                    found = score_block(frame, ids, matrix)
                    best = found if best is None else pd.concat([best, found])
                    best = best.sort_values(["query_id", "score", "doc_id"], ascending=[True, False, True]).groupby("query_id").head(k)
            if best is not None:
                yield best

        return d.mapInPandas(scan, schema)

    n_q = ceil(q.count() / max_queries)
    n_d = max(1, ceil(d.count() / block_rows))
    qb = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(n_q))).withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(n_d - 1))))
    db = d.withColumn("db", F.pmod(F.xxhash64("doc_id"), F.lit(n_d))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "doc_id": [], "score": []})
        return score_block(right, left["query_id"].to_numpy(), np.stack(left["qv"].to_numpy()).astype(np.float64))

    cast_qb = qb.withColumn("qb", F.col("qb").cast("long")).withColumn("db", F.col("db").cast("long"))
    cast_db = db.withColumn("qb", F.col("qb").cast("long")).withColumn("db", F.col("db").cast("long"))
    return cast_qb.groupBy("qb", "db").cogroup(cast_db.groupBy("qb", "db")).applyInPandas(meet, schema)


def dense_topk(queries: DataFrame, index: DataFrame, k: int, mode: str = "post", keep: Column | None = None,
               query_id: str = "query_id", doc_id: str = "doc_id", vector: str = "embedding", max_queries: int = 4096) -> DataFrame:
    """Exact top k by inner product: query_id, doc_id, score, rank.

    `keep` is a condition on the index columns. In mode `post` it is applied to
    the best 10k candidates, so fewer than k may remain; in mode `pre` before scoring.
    """
    if keep is None:
        return _pick_topk(pair_scores(queries, index, k, query_id, doc_id, vector, max_queries), k)
    if mode == "pre":
        return _pick_topk(pair_scores(queries, index.where(keep), k, query_id, doc_id, vector, max_queries), k)
    wide = k * fixed.CANDIDATE_FACTOR
    candidates = _pick_topk(pair_scores(queries, index, wide, query_id, doc_id, vector, max_queries), wide).drop("rank")
    allowed = index.where(keep).select(F.col(doc_id).alias("doc_id"))
    return _pick_topk(candidates.join(allowed, "doc_id", "left_semi"), k)


# --- BM25 -----------------------------------------------------------------------

class Bm25Index(NamedTuple):
    """postings (doc_id, term, tf), lengths (doc_id, dl), terms (term, df, idf), stats (one row: n, avgdl, mean_idf)."""

    postings: DataFrame
    lengths: DataFrame
    terms: DataFrame
    stats: DataFrame


def counted_documents(df: DataFrame, id: str, text: str) -> DataFrame:
    """doc_id, dl and the counted terms of each document in one row, written once: texts are cut into tokens here only and are not moved."""
    cut = df.select(F.col(id).alias("doc_id"), tokens_ws(text).alias("_t"))
    return stage(cut.select("doc_id", F.size("_t").alias("dl"), term_counts(F.col("_t")).alias("terms")), "counted")


def bm25_postings(counted: DataFrame) -> DataFrame:
    """doc_id, term, tf, dl. Rows of counts are moved once by id, so that later work per document stays in place.

    The number of tasks goes by the number of documents and is not made less for small rows: scoring holds a
    group per query and document of its task.
    """
    spark = counted.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(counted.count() / SCORED_DOCS))
    return counted.repartition(tasks, "doc_id").select("doc_id", "dl", F.explode("terms").alias("p")).select("doc_id", "p.term", "p.tf", "dl")


def document_frequency(counted: DataFrame) -> DataFrame:
    """term, df. Only counts are shuffled."""
    return counted.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def raw_idf(n: Column, df: Column) -> Column:
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def bm25_index(df: DataFrame, id: str, text: str) -> Bm25Index:
    """Index statistics over all rows. Negative idf values become a fraction of the mean idf."""
    return counted_index(counted_documents(df, id, text))


def counted_index(counted: DataFrame) -> Bm25Index:
    postings = bm25_postings(counted)
    lengths = counted.select("doc_id", "dl")
    sizes = lengths.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))
    n = sizes.select("n").scalar()
    dfs = document_frequency(counted).withColumn("_raw", raw_idf(n, F.col("df")))
    stats = dfs.agg(F.avg("_raw").alias("mean_idf"), F.count(F.lit(1)).alias("n_terms")).select(
        n.alias("n"), sizes.select("avgdl").scalar().alias("avgdl"), "mean_idf", "n_terms"
    )
    mean = stats.select("mean_idf").scalar()
    terms = dfs.select("term", "df", F.when(F.col("_raw") < 0, fixed.BM25_EPSILON * mean).otherwise(F.col("_raw")).alias("idf"))
    return Bm25Index(postings, lengths, terms, stats)


def query_terms(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """query_id, term, qtf; repeats in the query are counted."""
    words = queries.select(F.col(query_id).alias("query_id"), F.explode(tokens_ws(text)).alias("term"))
    return words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def match_terms(weights: DataFrame, postings: DataFrame, max_rows: int = BROADCAST_ROWS) -> list[DataFrame]:
    """Postings joined to query terms, as one frame per block of queries that is counted to fit a broadcast."""
    total = weights.count()
    blocks = max(1, ceil(total / max_rows))
    if blocks == 1:
        return [postings.join(F.broadcast(weights), "term")]
    marked = weights.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    return [postings.join(F.broadcast(marked.where(F.col("_b") == b).drop("_b")), "term") for b in range(blocks)]


def bm25_scores(queries: DataFrame, index: Bm25Index, query_id: str = "query_id", text: str = "query",
                max_rows: int = BROADCAST_ROWS) -> list[DataFrame]:
    """query_id, doc_id, score of all documents that share a term with a query, as one frame per block of queries.

    Postings lie together by document, so a document is scored where it is. The query
    weights are staged, because their number decides how they are handed out.
    """
    weights = stage(query_terms(queries, query_id, text).join(index.terms.select("term", "idf"), "term"), "weights")
    k1, b = fixed.BM25_K1, fixed.BM25_B
    avgdl = index.lengths.select(F.avg("dl")).scalar()
    tf, dl = F.col("tf"), F.col("dl")
    part = F.col("qtf") * F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
    return [matched.groupBy("query_id", "doc_id").agg(F.round(F.sum(part), SCORE_DIGITS).alias("score"))
            for matched in match_terms(weights, index.postings, max_rows)]


def bm25_topk(queries: DataFrame, index: Bm25Index, k: int, query_id: str = "query_id", text: str = "query",
              keep: DataFrame | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Top k positive scores per query: query_id, doc_id, score, rank. `keep` (doc_id) filters after scoring.

    Each task passes on at most k rows per query.
    """
    tops = []
    for scores in bm25_scores(queries, index, query_id, text, max_rows):
        scores = positive(scores)
        if keep is not None:
            scores = scores.join(keep.select("doc_id"), "doc_id", "left_semi")
        tops.append(_pick_topk(scores, k))
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def positive(hits: DataFrame, score: str = "score") -> DataFrame:
    return hits.where(F.col(score) > 0)


# --- Presentation ---------------------------------------------------------------

def format_hits(hits: DataFrame) -> DataFrame:
    """Listing of hits that carry their metadata: rank, tag, norm, score text, title of 90 characters, url."""
    return hits.select(
        "query_id", "rank",
        F.when(F.coalesce(F.col("is_valid").cast("boolean"), F.lit(False)), "VIGENTE").otherwise("DEROGADA").alias("tag"),
        F.concat_ws(" ", F.coalesce("type", F.lit("")), F.coalesce(F.col("number"), F.lit(""))).alias("norm"),
        F.format_string("%.4f", F.col("score")).alias("score_text"),
        F.substring(F.coalesce("title", F.lit("")), 1, 90).alias("title"),
        F.coalesce("url", F.lit("")).alias("url"),
    )


def side_by_side(dense: DataFrame, lexical: DataFrame) -> DataFrame:
    """Two systems' hits on one line per query and rank."""
    a = dense.select("query_id", "rank", F.col("doc_id").alias("dense_doc"), F.col("score").alias("dense_score"))
    b = lexical.select("query_id", "rank", F.col("doc_id").alias("lexical_doc"), F.col("score").alias("lexical_score"))
    return a.join(b, ["query_id", "rank"], "full_outer")
