"""Row generators: articles, citations, code blocks, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.functions.html import MARK, html_to_text
from lexmill.functions.rules import END, contains_any
from lexmill.functions.text import let, squash, strip
from lexmill.functions.tokens import tokens_ngrams, tokens_ws

LINE_FLAGS = "(?iuU)(?dm)"
# A citation has at least three characters, so this many pieces cover the context.
CONTEXT_PIECES = fixed.CITATION_CONTEXT_CHARS // 3 + 1
# Letters that match s, i and k in any case, but are not lower-cased to them one by one.
_CASE_TWINS = ("\u017f\u0131\u0130\u212a", "siik")
_MATCHES = "array<struct<target_text: string, pattern: int, pos: int, context: string, source_type: string>>"


def _blocks(text: Column, pattern: str) -> Column:
    """The text cut before each heading, without what precedes the first."""
    pieces = F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("")), pattern, MARK + "$0"), MARK)
    return F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))


def extract_articles(df: DataFrame, id: str, text: str, max_articles: int | None = None,
                     max_chars: int | None = None, is_html: bool = True) -> DataFrame:
    """One row per article: id, number, content, order (from 1). No heading gives no row."""
    pattern = LINE_FLAGS + fixed.ARTICLE_HEADING
    clean = html_to_text(text, "\n") if is_html else F.coalesce(F.col(text), F.lit(""))
    blocks = _blocks(clean, pattern)
    if max_articles is not None:
        blocks = F.slice(blocks, 1, max_articles)
    rows = df.select(id, F.posexplode(blocks).alias("pos", "block"))
    content = strip("block") if max_chars is None else F.substring(strip("block"), 1, max_chars)
    return rows.select(
        id,
        F.regexp_extract("block", pattern, 1).alias("number"),
        content.alias("content"),
        (F.col("pos") + 1).alias("order"),
    )


def split_code_articles(df: DataFrame, id: str, text: str, keep: list[str] = ()) -> DataFrame:
    """Article blocks of a code's plain text: id, kept columns, article_num, block of 40 characters or more."""
    pattern = "(?U)" + fixed.CODE_ARTICLE_HEADING
    rows = df.select(id, *keep, F.posexplode(_blocks(F.coalesce(F.col(text), F.lit("")), pattern)).alias("pos", "piece"))
    rows = rows.select(id, *keep, F.col("pos"), F.regexp_extract("piece", pattern, 1).alias("article_num"), strip("piece").alias("block"))
    return min_length(rows, "block", fixed.MIN_BLOCK_CHARS)


def min_length(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.where(F.length(col) >= n)


def citation_type(context: Column) -> Column:
    """Type by the words before the citation, tested in order."""
    kind = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, cues in fixed.CITATION_CUES:
        kind = kind.when(contains_any(context, cues), F.lit(name))
    return F.coalesce(kind, F.lit(fixed.CITATION_DEFAULT))


def _pattern_matches(text: Column, index: int, pattern: str, label: str) -> Column:
    """Matches of one pattern with the characters before them, as an array in text order."""
    n = fixed.CITATION_CONTEXT_CHARS
    pieces = F.split(F.regexp_replace(text, "(?iuU)" + pattern, MARK + "$0" + END), MARK)

    def with_tails(ps, tails):
        def one(piece, i):
            start = F.greatest(i + 2 - CONTEXT_PIECES, F.lit(1))
            before = F.array_join(F.slice(tails, start, i + 2 - start), "")
            return F.struct(
                squash(F.substring_index(piece, END, 1)).alias("target_text"),
                F.lit(index).alias("pattern"),
                i.alias("pos"),
                F.right(before, F.lit(n)).alias("context"),
                F.lit(label).alias("source_type"),
            )

        return F.transform(F.slice(ps, F.lit(2), F.greatest(F.size(ps) - 1, F.lit(0))), one)

    def with_pieces(ps):
        tails = F.transform(ps, lambda p: F.right(F.replace(p, F.lit(END), F.lit("")), F.lit(n)))
        return let(tails, lambda ts: with_tails(ps, ts))

    return let(pieces, with_pieces)


def citations_of(text: Column) -> Column:
    """Citations of one text: distinct targets, each typed by its first match in (pattern, position) order.

    A pattern is tried only where the text holds one of the words it needs; most texts hold few of them.
    Everything stays inside the row: repeats are dropped by sorting on the target
    and comparing neighbours, so no shuffle is needed.
    """

    def found(t):
        return let(F.lower(F.translate(t, *_CASE_TWINS)), lambda low: F.concat(*[
            F.when(contains_any(low, fixed.CITATION_NEEDS[i]), _pattern_matches(t, i, p, label)).otherwise(F.array().cast(_MATCHES))
            for i, (p, label) in enumerate(fixed.CITATION_PATTERNS)]))

    def first_per_target(s):
        kept = F.filter(s, lambda x, i: (i == 0) | (x["target_text"] != F.get(s, i - 1)["target_text"]))
        in_order = F.sort_array(F.transform(kept, lambda x: F.struct(
            x["pattern"], x["pos"], x["target_text"], x["context"], x["source_type"])))
        return F.transform(in_order, lambda x: F.struct(
            x["target_text"], let(F.lower(x["context"]), citation_type).alias("citation_type"), x["source_type"]))

    matches = let(F.translate(text, MARK + END, ""), found)
    return let(F.sort_array(matches), first_per_target)


def extract_citations(df: DataFrame, id: str, text: str, max_citations: int | None = None,
                      max_chars: int | None = None, is_html: bool = True) -> DataFrame:
    """One row per distinct citation: id, target_text, citation_type, source_type, order (from 1)."""
    clean = html_to_text(text, "\n") if is_html else F.coalesce(F.col(text), F.lit(""))
    found = citations_of(clean)
    if max_citations is not None:
        found = F.slice(found, 1, max_citations)
    rows = df.select(id, F.posexplode(found).alias("pos", "c"))
    target = F.col("c.target_text") if max_chars is None else F.substring("c.target_text", 1, max_chars)
    return rows.select(id, target.alias("target_text"), "c.citation_type", "c.source_type", (F.col("pos") + 1).alias("order"))


def cap_children(df: DataFrame, id: str, children: str, max_rows: int, text: str, max_chars: int) -> DataFrame:
    """Explode an array of structs to at most `max_rows` per parent, one text field cut to `max_chars`."""
    rows = df.select(id, F.posexplode(F.slice(children, 1, max_rows)).alias("pos", "child"))
    out = rows.select(id, (F.col("pos") + 1).alias("order"), "child.*")
    return out.withColumn(text, F.substring(text, 1, max_chars))


def explode_tokens(df: DataFrame, id: str | list[str], text: str, how: str = "ws") -> DataFrame:
    """One row per token: `ws` whitespace pieces, `ngrams` one- and two-word grams."""
    ids = [id] if isinstance(id, str) else id
    tokens = tokens_ws(text) if how == "ws" else tokens_ngrams(text)
    return df.select(*ids, F.explode(tokens).alias("term"))
