"""Corpus profile: counts, shares, summary, checks, sorting and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.functions.text import number_token, short_hash, type_and_number
from lexmill.functions.tokens import title_words
from lexmill.operators.skew import first_by


def count_by(df: DataFrame, col: str, fill: str = fixed.TYPE_MISSING, n: int | None = 12) -> DataFrame:
    """Rows per value, null named, the `n` largest."""
    counts = df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit(fill)).alias(col)).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), col)
    return ordered if n is None else ordered.limit(n)


def count_by_year(df: DataFrame, date: str) -> DataFrame:
    return (
        df.groupBy(F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("year").isNotNull()).orderBy("year")
    )


def top_words(df: DataFrame, title: str, n: int = 80, stopwords: list[str] | None = None) -> DataFrame:
    words = df.select(F.explode(title_words(title, stopwords)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(n)


def label_pivot(df: DataFrame, group: str, label: str, names: dict | None = None) -> DataFrame:
    """Rows per group and label, one column per label, zero-filled, smallest total first."""
    names = names or fixed.VALIDITY_NAMES
    cols = [F.count_if(F.col(label) == code).alias(name) for code, name in sorted(names.items())]
    counts = df.where(F.col(label).isin(list(names))).groupBy(group).agg(*cols)
    total = sum((F.col(name) for name in names.values()), F.lit(0))
    return counts.withColumn("total", total).orderBy("total", group)


def share_by(df: DataFrame, col: str, fill: str = fixed.CITATION_DEFAULT) -> DataFrame:
    """Rows per value and their percentage."""
    counts = df.groupBy(F.coalesce(F.col(col), F.lit(fill)).alias(col)).agg(F.count(F.lit(1)).alias("n"))
    pct = F.round(100.0 * F.col("n") / counts.select(F.sum("n")).scalar(), 1)
    return counts.withColumn("pct", pct)


def validity_counts(valid: Column) -> list[Column]:
    return [
        F.count_if(valid == 1).alias("valid"),
        F.count_if(valid == 0).alias("invalid"),
        F.count_if(valid.isNull()).alias("unknown"),
    ]


def corpus_summary(norms: DataFrame, citations: DataFrame) -> DataFrame:
    """One row: rows, distinct types, dated rows, year range, validity, citations, null titles."""
    valid = F.col("is_valid").cast("int")
    return norms.agg(
        F.count(F.lit(1)).alias("norms"),
        F.count_distinct("type").alias("types"),
        F.count("date").alias("dated"),
        F.year(F.min("date")).alias("first_year"),
        F.year(F.max("date")).alias("last_year"),
        *validity_counts(valid),
        F.count_if(F.col("title").isNull()).alias("null_titles"),
    ).withColumn("citations", citations.select(F.count(F.lit(1))).scalar())


def table_checks(norms: DataFrame, articles: DataFrame, citations: DataFrame) -> DataFrame:
    """Row counts of the three tables and validation states of the norms, as (check, n)."""
    def counted(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")

    states = norms.agg(*validity_counts(F.col("is_valid").cast("int"))).unpivot([], ["valid", "invalid", "unknown"], "check", "n")
    return (
        counted(norms, "norms").unionByName(counted(articles, "articles"))
        .unionByName(counted(citations, "citations")).unionByName(states)
    )


def articles_per_code(df: DataFrame, code: str, label: str = "label") -> DataFrame:
    return df.groupBy(code).agg(F.count(F.lit(1)).alias("articles"), F.count_if(F.col(label) == 0).alias("repealed"))


def recent(df: DataFrame, ts: str, id: str, n: int = 0) -> DataFrame:
    """Latest first; `n` rows, or all for 0."""
    ordered = df.orderBy(F.desc_nulls_last(ts), id)
    return ordered.limit(n) if n else ordered


def newest_first(versions: DataFrame, date: str = "version_date", id: str = "id") -> DataFrame:
    return versions.orderBy(F.desc_nulls_last(date), F.desc(id))


def cap(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first `n` rows by an order, after whatever filter came before."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, key: list[str], start: int, stop: int) -> DataFrame:
    """Rows `start` (from 0) to before `stop` by a total order."""
    return df.orderBy(*key).offset(start).limit(stop - start)


def display_versions(versions: DataFrame) -> DataFrame:
    """Version listing: id, norm, date, short hash, state."""
    return versions.select(
        "id",
        type_and_number("type", "number").alias("norm"),
        F.coalesce(F.date_format("version_date", "yyyy-MM-dd"), F.lit("")).alias("version_day"),
        short_hash("text_hash").alias("hash"),
        "state",
    )


def find_by_number(targets: DataFrame, docs: DataFrame, id: str, number: str = "number", title: str = "title") -> DataFrame:
    """For each target number the first document (by id) with the same number token whose title holds
    the full number in any case; `found` is false where there is none. Copies of a
    title are folded to their first document before the join.
    """
    t = targets.select(number).distinct().withColumn("_token", F.coalesce(number_token(number), F.col(number)))
    d = docs.select(F.col(id), F.col(title).alias("_title"), F.coalesce(number_token(number), F.col(number)).alias("_token"))
    d = d.groupBy("_token", "_title").agg(F.min(id).alias(id))
    hits = t.join(d, "_token").where(F.upper("_title").contains(F.upper(number)))
    first = hits.groupBy(number).agg(F.min(id).alias(id))
    return targets.join(first, number, "left").withColumn("found", F.col(id).isNotNull())


def distinct_first(df: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """One row per value of `cols`, the first by an order."""
    return first_by(df, cols, order)
