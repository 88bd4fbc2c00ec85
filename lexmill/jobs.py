"""Whole jobs put together from the operators: ingest, validation, index, search, evaluation, datasets, training, profile."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import fixed, schemas
from lexmill.functions.html import html_to_text
from lexmill.functions.rules import banner_status, label_article, marker_status, norm_status, with_level
from lexmill.functions.text import classifier_text, embedding_text, present, squash, url_tail
from lexmill.operators import classify, dataset, features, ingest, irmetrics, profile, retrieval
from lexmill.operators.extract import extract_articles, extract_citations, split_code_articles
from lexmill.session import stage
from lexmill.sources import landing, postings


# --- Ingest -------------------------------------------------------------------

class Corpus(NamedTuple):
    norms: DataFrame
    versions: DataFrame
    articles: DataFrame
    citations: DataFrame
    outcomes: DataFrame | None = None


def ingest_batch(stored: Corpus, docs: DataFrame, details: DataFrame, now: Column, seq: str = "seq", only_valid: bool = False,
                 max_articles: int | None = None, max_citations: int | None = None, max_chars: int | None = None,
                 article_chars: int | None = None, target_chars: int | None = None, limits: dict[str, int] | None = None,
                 pages: DataFrame | None = None) -> Corpus:
    """Landed documents and details to the next state of all four tables.

    Documents carry `seq`, their order of arrival; blank ids are left out, and of repeated ids the first counts.
    `pages` (id, html, error) adds the banner of a landed page, or the error met when fetching it, to a norm's status.
    Texts of any length stay unless `max_chars` is given (the sampling collector has
    `fixed.MAX_TEXT_CHARS`), which also drops empty ones; invalid norms are left out when asked.
    Counts (`fixed.MAX_ARTICLES`, `fixed.MAX_CITATIONS`), characters (`fixed.ARTICLE_CHARS`,
    `fixed.TARGET_CHARS`) and field limits (`fixed.FIELD_LIMITS`) apply only where given. Only added
    and updated norms are taken apart again; one that yields no article or citation keeps its old ones.
    """
    once = ingest.keep_new_ids(docs, "id", [seq])
    page = error = None
    if pages is not None:
        once = once.join(ingest.first_seen(pages.select("id", F.col("html").alias("_html"), F.col("error").alias("_error")), "id", ["_html"]), "id", "left")
        page, error = F.col("d._html"), F.col("d._error")
    items = landing.build_items(once, details, page_html=page, error=error, keep=[seq])
    items = items if max_chars is None else ingest.keep_sized(items, "raw_text", max_chars)
    items = ingest.drop_invalid(items) if only_valid else items
    merged = ingest.merge_versions(stored.norms, stored.versions, with_level(items), now, limits=limits)
    touched = merged.outcomes.where(F.col("outcome") != "unchanged")
    changed = stage(touched.groupBy("norm_id").agg(F.max_by("raw_text", seq).alias("raw_text")), "changed")
    articles = lambda rows: schemas.conform(extract_articles(rows, "norm_id", "raw_text", max_articles, article_chars), schemas.ARTICLES)
    citations = lambda rows: schemas.conform(extract_citations(rows, "norm_id", "raw_text", max_citations, target_chars), schemas.CITATIONS)

    def replaced(children: DataFrame, taken: Callable[[DataFrame], DataFrame]) -> DataFrame:
        held = changed.join(children.select("norm_id").distinct(), "norm_id", "left_semi")
        return ingest.replace_children(children, taken(changed), changed, again=taken(held))

    return Corpus(merged.norms, merged.versions, replaced(stored.articles, articles), replaced(stored.citations, citations), merged.outcomes)


def collect_sample(stored: Corpus, docs: DataFrame, details: DataFrame, now: Column, group: str = "group", date: str = "fechaPublicacion",
                   plan: list[tuple[str, str]] = tuple(fixed.SAMPLING_PLAN), per_entry: int = 100, target: int = 700,
                   known: DataFrame | None = None, max_chars: int = fixed.MAX_TEXT_CHARS, **options) -> Corpus:
    """The sampling collector: norms by a plan of groups, quotas counted on norms that can be added.

    Before the quotas, ids collected earlier (`known`: id), documents without a
    detail, and texts that are empty or over `max_chars` drop out.
    """
    fit = ingest.keep_sized(details.select("id", "textoCompleto"), "textoCompleto", max_chars).select("id").distinct()
    able = docs.join(fit, "id", "left_semi")
    able = able if known is None else ingest.skip_known(able, known, "id")
    chosen = stage(ingest.quota_sample(able, "id", group, date, list(plan), per_entry, target), "sample").select("id")
    return ingest_batch(stored, docs.join(chosen, "id", "left_semi"), details, now, max_chars=max_chars, **options)


# --- Validation -----------------------------------------------------------------

def validate(norms: DataFrame, versions: DataFrame, now: Column, force: bool = False, limit: int = 0,
             pages: DataFrame | None = None) -> DataFrame:
    """Norms still to validate (all when forced, latest first when limited) with their new status.

    The newest stored text is read for a marker; `pages` (url, html) adds the
    banners of landed pages. Adds new_valid, new_message, change and error.
    """
    todo = ingest.pending(norms, force)
    todo = profile.recent(todo, "updated_at", "id", limit) if limit else todo
    rows = ingest.latest_version(todo, versions)
    none = F.lit(None).cast("struct<is_valid: boolean, status: string>")
    if pages is not None:
        rows = rows.join(pages.select("url", F.col("html").alias("_html")), "url", "left")
    banner = banner_status("_html", reason_chars=fixed.BANNER_REASON_CHARS) if pages is not None else none
    marker = marker_status(html_to_text("raw_text", " ", always=True), fixed.MARKER_REASON_CHARS)
    error = F.when(present(url_tail("url")).isNull(), F.lit("no id in url"))
    judged = rows.withColumn("_s", norm_status(banner, marker)).select(
        *norms.columns, F.col("_s.is_valid").cast("int").alias("new_valid"), F.col("_s.status").alias("new_message"),
        error.alias("error"), now.alias("checked_at"))
    return ingest.validity_changes(judged, "is_valid", "new_valid")


def apply_validation(norms: DataFrame, judged: DataFrame) -> DataFrame:
    """Norms with the outcome of `validate` written in; rows in error stay as they were."""
    news = judged.where(F.col("error").isNull()).select("id", "new_valid", "new_message", "checked_at")
    hit = F.col("checked_at").isNotNull()
    joined = norms.join(news, "id", "left")
    return joined.withColumns({
        "is_valid": F.when(hit, F.col("new_valid")).otherwise(F.col("is_valid")),
        "validation_message": F.when(hit, F.col("new_message")).otherwise(F.col("validation_message")),
        "validation_date": F.coalesce("checked_at", "validation_date"),
    }).select(*norms.columns)


def list_versions(norms: DataFrame, versions: DataFrame) -> DataFrame:
    """Every version with its norm, short hash and state, newest first."""
    state = ingest.version_state(versions.select("id", "norm_id", "version_date", "text_hash"))
    joined = ingest.versions_with_norms(state, norms.select("id", "type", "number")).select("v.*", "n.type", "n.number")
    return profile.display_versions(profile.newest_first(joined))


# --- Index and search -----------------------------------------------------------

def index_rows(norms: DataFrame, versions: DataFrame, level: int | None = None, only_valid: bool = True, limit: int = 0,
               text_chars: int | None = None) -> DataFrame:
    """Norms to index with the text to encode, whole unless `text_chars` takes its opening."""
    rows = ingest.keep_valid(norms, level) if only_valid else norms if level is None else norms.where(F.col("level") == level)
    rows = profile.recent(rows, "updated_at", "id", limit) if limit else rows
    latest = ingest.latest_version(rows, versions)
    clean = squash(html_to_text("raw_text", " "))
    c = F.col
    return latest.select(
        c("id").alias("norm_id"), "title", "type", "number", "url", "level", c("is_valid").cast("boolean").alias("is_valid"), "status",
        embedding_text(c("type"), c("number"), c("title"), clean, text_chars).alias("text"),
    )


def build_index(norms: DataFrame, versions: DataFrame, encoder: Callable[[pd.Series], np.ndarray] | None = None,
                level: int | None = None, only_valid: bool = True, limit: int = 0, text_chars: int | None = None) -> DataFrame:
    """Index metadata with a unit vector per norm, ready to be written."""
    return retrieval.encode(index_rows(norms, versions, level, only_valid, limit, text_chars), "text", encoder)


def search(index: DataFrame, queries: DataFrame, k: int = 5, only_valid: bool = True, level: int | None = None,
           encoder: Callable[[pd.Series], np.ndarray] | None = None, mode: str = "post") -> DataFrame:
    """Dense hits of many queries (query_id, query) with the metadata of the norms."""
    keep = None
    if only_valid:
        keep = F.coalesce(F.col("is_valid"), F.lit(True))
    if level is not None:
        keep = (F.col("level") == level) if keep is None else keep & (F.col("level") == level)
    vectors = retrieval.encode(queries.select("query_id", "query"), "query", encoder)
    hits = stage(retrieval.dense_topk(vectors, index, k, mode, keep, doc_id="norm_id"), "hits")
    return hits.join(index.drop("embedding").withColumnRenamed("norm_id", "doc_id"), "doc_id")


def search_bm25(index: DataFrame, queries: DataFrame, k: int = 5, only_valid: bool = True, text: str = "title", stored: str | None = None) -> DataFrame:
    """BM25 hits over the titles of the index, with metadata.

    `stored` is the path of a lexical index that `postings.write_bm25` made of the same rows; without it one is built for this call.
    """
    keep = index.where(F.coalesce(F.col("is_valid"), F.lit(True))).select(F.col("norm_id").alias("doc_id")) if only_valid else None
    if stored:
        found = postings.search_stored(queries, postings.load_bm25(index.sparkSession, stored), k, keep=keep).hits
    else:
        found = retrieval.bm25_topk(queries, retrieval.bm25_index(index, "norm_id", text), k, keep=keep)
    hits = stage(found, "hits")
    return hits.join(index.drop("embedding").withColumnRenamed("norm_id", "doc_id"), "doc_id")


def evaluate_search(index: DataFrame, queries: DataFrame, k: int = 5, encoder: Callable[[pd.Series], np.ndarray] | None = None) -> DataFrame:
    """Dense against BM25 on queries with keywords: one row per metric with both means and the gain."""
    systems = {"dense": search(index, queries, k, encoder=encoder), "bm25": search_bm25(index, queries, k)}
    return irmetrics.mean_metrics(irmetrics.evaluate(queries, systems, k), "dense", "bm25")


# --- Datasets and training --------------------------------------------------------

def validity_dataset(codes: DataFrame, ratio: float = 1.5, seed: int = 42, **cuts: int) -> DataFrame:
    """Balanced article samples from the published texts of codes (code_id, code_name, html); `cuts` are those of `label_article`."""
    plain = codes.select("code_id", "code_name", html_to_text("html", " ", always=True).alias("text"))
    labelled = label_article(split_code_articles(plain, "code_id", "text", ["code_name"]), **cuts)
    keyed = stage(labelled.withColumn("sample_id", F.concat_ws("#", "code_id", F.col("pos").cast("string"))).drop("pos"), "labelled")
    return dataset.balance(keyed, "label", "sample_id", ratio, seed)


def hierarchy_dataset(norms: DataFrame, versions: DataFrame, text_chars: int | None = None) -> DataFrame:
    """Title and text (its opening where `text_chars` is given) of each norm with its level; the type is left out because the level comes from it."""
    latest = ingest.latest_version(norms, versions)
    clean = html_to_text("raw_text", " ")
    rows = latest.select(F.col("id").alias("doc_id"), classifier_text(F.col("title"), clean, text_chars).alias("text"), F.coalesce("level", F.lit(fixed.LEVEL_DEFAULT)).alias("label"))
    return dataset.keep_common_classes(rows, "label", 5, 1, 5)


class TrainingReport(NamedTuple):
    trained: classify.Trained
    report: DataFrame
    confusion: DataFrame
    cv: DataFrame


def train_text_classifier(docs: DataFrame, train, vocab: int, positive: int | None, folds: int = 5, share: float = 0.15,
                          seed: int = 42, min_df: int = 2) -> TrainingReport:
    """Split, cross-validate on the training part, fit, and report on the held-out part. `docs`: doc_id, label, text."""
    dataset.require_rows(docs)
    split = dataset.stratified_split(docs, "label", "doc_id", share, seed, exact=True)
    parts = dataset.folds_of_part(split.select("doc_id", "label", "text", "part"), "label", "doc_id", "train", folds, seed)
    counted = features.count_ngrams(parts, "doc_id", "text", "fold", ["label"])
    fit_postings, held_postings = counted.of(*range(folds)), counted.of(-1)
    fit_on, held_out = (p.docs().select("doc_id", "label") for p in (fit_postings, held_postings))
    cv = classify.fold_stats(classify.cross_validate(fit_on, fit_postings, "label", train, folds, vocab, min_df, positive, seed))
    trained = classify.fit_text_model(fit_on, fit_postings, "label", vocab, min_df, train)
    matrix = stage(classify.confusion(classify.score(trained, held_out, held_postings)), "confusion")
    return TrainingReport(trained, classify.classification_report(matrix), matrix, cv)


def train_validity(samples: DataFrame, text: str = "raw_text", id: str = "sample_id") -> TrainingReport:
    docs = samples.select(F.col(id).alias("doc_id"), "label", F.coalesce(text, F.lit("")).alias("text"))
    return train_text_classifier(docs, classify.train_logreg, 20_000, 1)


def train_hierarchy(norms: DataFrame, versions: DataFrame, trees: int = 200, depth: int = 30) -> TrainingReport:
    forest = lambda vectors, label: classify.train_forest(vectors, label, trees, depth)
    return train_text_classifier(hierarchy_dataset(norms, versions), forest, 15_000, None)


# --- Profile ------------------------------------------------------------------------

def profile_corpus(norms: DataFrame, citations: DataFrame, samples: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables behind the corpus report, by name."""
    out = {
        "summary": profile.corpus_summary(norms, citations),
        "types": profile.count_by(norms, "type"),
        "years": profile.count_by_year(norms, "date"),
        "words": profile.top_words(norms, "title"),
        "citations": profile.share_by(citations, "citation_type"),
    }
    if samples is not None:
        out["validity"] = profile.label_pivot(samples, "code_name", "label")
    return out
