"""Retrieval metrics over hits of many queries and systems at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.session import stage

KEY = ["system", "query_id"]


def evaluation_queries(spark: SparkSession) -> DataFrame:
    """The fixed evaluation set: query_id, query, keywords."""
    rows = [(i, q, kw) for i, (q, kw) in enumerate(fixed.EVALUATION_QUERIES, 1)]
    return spark.createDataFrame(rows, "query_id int, query string, keywords array<string>")


def judge(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Hits (query_id, title, type) with `rel`: whether any keyword of the query is in title plus type."""
    text = F.concat_ws(" ", F.lower(F.coalesce("title", F.lit(""))), F.lower(F.coalesce("type", F.lit(""))))
    joined = hits.join(queries.select("query_id", "keywords"), "query_id").withColumn("_text", text)
    rel = F.exists("keywords", lambda w: F.col("_text").contains(F.lower(w)))
    return joined.withColumn("rel", F.coalesce(rel, F.lit(False)).cast("int")).drop("_text")


def _per_query(judged: DataFrame, queries: DataFrame, systems: list[str], cols: list) -> DataFrame:
    """Aggregates per system and query, zero for queries without hits."""
    scores = judged.groupBy(*KEY).agg(*cols)
    names = [c for c in scores.columns if c not in KEY]
    grid = queries.select("query_id").distinct().select("query_id", F.explode(F.array(*[F.lit(s) for s in systems])).alias("system"))
    return grid.join(scores, KEY, "left").select(*KEY, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in names])


def _top(judged: DataFrame, k: int) -> DataFrame:
    return judged.where(F.col("rank") <= k)


def precision_col(k: int):
    return (F.sum("rel") / F.lit(float(k))).alias("precision")


def mrr_col():
    return F.coalesce(1.0 / F.min(F.when(F.col("rel") == 1, F.col("rank"))), F.lit(0.0)).alias("mrr")


def _discount(position):
    return F.log(F.lit(2.0)) / F.log(position + 1)


def ndcg_cols() -> list:
    """DCG of the hits over the DCG of the same hits moved to the front."""
    return [F.sum(F.col("rel") * _discount(F.col("rank"))).alias("_dcg"), F.sum("rel").alias("_hits")]


def finish_ndcg(df: DataFrame) -> DataFrame:
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("_hits").cast("int"), F.lit(1))), F.lit(0.0), lambda a, i: a + _discount(i))
    return df.withColumn("ndcg", F.when(F.col("_hits") > 0, F.col("_dcg") / ideal).otherwise(0.0)).drop("_dcg", "_hits")


def precision_at_k(judged: DataFrame, queries: DataFrame, k: int, systems: list[str]) -> DataFrame:
    """Relevant hits over k, however many came back."""
    return _per_query(_top(judged, k), queries, systems, [precision_col(k)])


def mrr_at_k(judged: DataFrame, queries: DataFrame, k: int, systems: list[str]) -> DataFrame:
    return _per_query(_top(judged, k), queries, systems, [mrr_col()])


def ndcg_at_k(judged: DataFrame, queries: DataFrame, k: int, systems: list[str]) -> DataFrame:
    return finish_ndcg(_per_query(_top(judged, k), queries, systems, ndcg_cols()))


def keyword_recall_at_k(judged: DataFrame, queries: DataFrame, k: int, systems: list[str]) -> DataFrame:
    """Share of a query's keywords found in the titles of its first k hits."""
    title = F.lower(F.coalesce("title", F.lit("")))
    top = _top(judged, k).withColumn("_title", title)
    hit = F.filter(F.col("keywords"), lambda w: F.col("_title").contains(F.lower(w)))
    found = top.select(*KEY, F.explode(hit).alias("_w")).groupBy(*KEY).agg(F.count_distinct("_w").alias("_found"))
    grid = _per_query(found, queries, systems, [F.first("_found").cast("double").alias("_found")])
    sized = grid.join(queries.select("query_id", F.size(F.array_distinct("keywords")).alias("_n")), "query_id")
    recall = F.when(F.col("_n") > 0, F.col("_found") / F.col("_n")).otherwise(0.0)
    return sized.select(*KEY, recall.alias("keyword_recall"))


def evaluate(queries: DataFrame, systems: dict[str, DataFrame], k: int) -> DataFrame:
    """All metrics per system and query. Each system's hits carry query_id, rank, title, type.

    The judged hits feed two branches and are few, so they are staged once.
    """
    hits = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("system"), "query_id", "rank", "title", "type") for name, df in systems.items()
    ])
    judged = stage(judge(hits, queries), "judged")
    base = finish_ndcg(_per_query(_top(judged, k), queries, list(systems), [precision_col(k), mrr_col(), *ndcg_cols()]))
    return base.join(keyword_recall_at_k(judged, queries, k, list(systems)), KEY)


def mean_metrics(metrics: DataFrame, first: str, second: str, names: list[str] = ("precision", "keyword_recall", "mrr", "ndcg")) -> DataFrame:
    """One row per metric: mean of each system and their difference."""
    long = metrics.unpivot(KEY, list(names), "metric", "value")
    mean = lambda s: F.avg(F.when(F.col("system") == s, F.col("value")))
    out = long.groupBy("metric").agg(mean(first).alias(first), mean(second).alias(second))
    return out.withColumn("gain", F.col(first) - F.col(second))
