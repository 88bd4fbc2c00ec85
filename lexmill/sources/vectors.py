"""A dense index that is stored by cluster, and exact search that passes over clusters.

Every vector lies in the folder of its nearest centre. For a query q, a centre m and the greatest distance r of its
vectors, no vector of the cluster scores above q . m + |q| r, so clusters that cannot enter the first k are not read.
Centres only decide how much is passed over, never what is found.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.retrieval import _local_topk, _pick_topk
from lexmill.session import read_text, stage, write_text

#: Centres at most, and vectors they are fitted on at most (those with the smallest hashes of their ids).
CLUSTERS, SAMPLE = 256, 16_384
#: Clusters of a query that are scored first, those with the greatest bounds.
PROBES = 4
#: What rounding may take from a bound.
SLACK = 1e-6


class Stored(NamedTuple):
    """vectors (the columns given, then cluster and away, the distance to its centre) and clusters (cluster, n, radius, centre)."""

    vectors: DataFrame
    clusters: DataFrame


def _centres(sample: np.ndarray, many: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds, started at different vectors; one without vectors stays where it is."""
    different = np.unique(sample, axis=0)
    centres = different[np.random.default_rng(seed).permutation(len(different))[:many]].copy()
    for _ in range(rounds):
        at = _nearest(sample, centres)
        for c in np.unique(at):
            centres[c] = sample[at == c].mean(axis=0)
    return centres


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def write_vectors(df: DataFrame, id: str, vector: str, path: str, clusters: int = CLUSTERS, sample: int = SAMPLE, seed: int = 42) -> None:
    """Stores all rows with a vector, all columns kept; rows without one cannot be found and are not stored.

    A cluster that holds many rows is written as several files, so no task holds a whole one.
    """
    spark = df.sparkSession
    rows = df.where(F.col(vector).isNotNull())
    known = rows.select(F.col(vector).alias("v"), F.xxhash64(id).alias("h")).orderBy("h").limit(sample).toPandas()["v"]
    fitted = _centres(np.stack(known.to_numpy()).astype(np.float64), max(1, min(clusters, len(known) // 64)), seed) if len(known) else np.zeros((0, 0))

    @F.pandas_udf("cluster int, away double")
    def place(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack(vectors.to_numpy()).astype(np.float64)
        at = _nearest(x, fitted)
        return pd.DataFrame({"cluster": at.astype(np.int32), "away": np.linalg.norm(x - fitted[at], axis=1)})

    placed = rows.withColumn("_place", place(F.col(vector))).select(*rows.columns, "_place.away", "_place.cluster")
    placed.hint("rebalance", "cluster").write.mode("overwrite").partitionBy("cluster").parquet(f"{path}/vectors")
    write_text(spark, f"{path}/schema", placed.schema.json())
    stored = spark.read.schema(placed.schema).parquet(f"{path}/vectors")
    reach = stored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    table = [(r["cluster"], r["n"], r["radius"], fitted[r["cluster"]].tolist()) for r in reach]
    spark.createDataFrame(table, "cluster int, n long, radius double, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/clusters")


def load_vectors(spark: SparkSession, path: str) -> Stored:
    schema = T.StructType.fromJson(json.loads(read_text(spark, f"{path}/schema")))
    return Stored(spark.read.schema(schema).parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/clusters"))


class Hits(NamedTuple):
    """hits (query_id, doc_id, score, rank) and, per query, how many vectors lie in clusters that were read for it (query_id, scored, vectors)."""

    hits: DataFrame
    scored: DataFrame


def search_vectors(queries: DataFrame, index: Stored, k: int, keep: Column | None = None, query_id: str = "query_id", doc_id: str = "doc_id",
                   query_vector: str = "embedding", vector: str = "embedding", probes: int = PROBES, max_queries: int = 4096) -> Hits:
    """The exact top k by inner product among the vectors that meet `keep`, as `dense_topk` gives them.

    Queries go out in blocks of about `max_queries`, one after the other, each as one matrix; bounds are a table of queries by
    clusters, both bounded. The clusters with the greatest bounds are read first; the k-th best score found there is one that a
    better vector must reach, so of the others only those are read whose bound does. The index is read where it lies:
    a cluster that no query of the block can use is left out by its folder, and only hits are shuffled.
    Queries without a vector have no hits.
    """
    spark = queries.sparkSession
    info = index.clusters.orderBy("cluster").toPandas()
    asked = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("qv"))
    id_type, doc_type = asked.schema["query_id"].dataType.simpleString(), index.vectors.schema[doc_id].dataType.simpleString()
    schema, report = f"query_id {id_type}, doc_id {doc_type}, score double", f"query_id {id_type}, scored long, vectors long"
    able = index.vectors if keep is None else index.vectors.where(keep)
    rows = able.select("cluster", F.col(doc_id).alias("doc_id"), F.col(vector).alias("v"))

    def scan(ids: np.ndarray, matrix: np.ndarray, chosen: np.ndarray) -> DataFrame:
        """Best k of each query over the clusters chosen for it (queries x clusters)."""
        numbers = info["cluster"].to_numpy()
        shared = spark.sparkContext.broadcast((ids, matrix, dict(zip(numbers.tolist(), chosen.T))))

        def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, matrix, chosen = shared.value
            best = None
            for frame in frames:
                for cluster, docs in frame.groupby("cluster", sort=False):
                    at = np.flatnonzero(chosen[cluster])
                    if not len(at):
                        continue
                    scores = np.stack(docs["v"].to_numpy()).astype(np.float64) @ matrix[at].T
                    found = _local_topk(scores, docs["doc_id"].to_numpy(), ids[at], k)
                    best = found if best is None else pd.concat([best, found])
                    best = best.sort_values(["query_id", "score", "doc_id"], ascending=[True, False, True]).groupby("query_id").head(k)
            if best is not None:
                yield best

        wanted = numbers[chosen.any(axis=0)].tolist()
        return _pick_topk(rows.where(F.col("cluster").isin(wanted)).mapInPandas(score, schema), k)

    hits, scored = spark.createDataFrame([], f"{schema}, rank int"), spark.createDataFrame([], report)
    blocks = max(1, ceil(asked.count() / max_queries)) if len(info) else 0
    for block in range(blocks):
        head = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toPandas()
        if not len(head):
            continue
        ids, matrix = head["query_id"].to_numpy(), np.stack(head["qv"].to_numpy()).astype(np.float64)
        bounds = matrix @ np.stack(info["centre"].to_numpy()).T + np.linalg.norm(matrix, axis=1)[:, None] * info["radius"].to_numpy()
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, np.argsort(-bounds, axis=1, kind="stable")[:, :probes], True, axis=1)
        best = stage(scan(ids, matrix, first), "first-hits")
        full = dict(best.where(F.col("rank") == k).select("query_id", "score").toPandas().itertuples(index=False, name=None))
        reach = np.array([full.get(i, -np.inf) for i in ids])
        rest = ~first & ~(bounds + SLACK < reach[:, None])
        both = best.drop("rank").unionByName(scan(ids, matrix, rest).drop("rank")) if rest.any() else best.drop("rank")
        hits = hits.unionByName(stage(_pick_topk(both, k), "hits"))
        counts = (first | rest) @ info["n"].to_numpy()
        scored = scored.unionByName(spark.createDataFrame(pd.DataFrame({"query_id": ids, "scored": counts, "vectors": int(info["n"].sum())}), report))
    return Hits(hits, scored)
