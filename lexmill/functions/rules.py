"""Rule labels: hierarchy level, validity status, repeal notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import fixed
from lexmill.functions.html import MARK, SILENT, TAG, decode_entities
from lexmill.functions.text import fold, let, present, strip

END = "\u0002"


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def level(kind: Column | str, title: Column | str) -> Column:
    """Hierarchy level from the type, then from type and title, else the default level."""

    def rule(c: Column) -> Column:
        branches = F.when(F.lit(False), F.lit(None).cast("int"))
        for number, words in fixed.LEVEL_KEYWORDS:
            branches = branches.when(c.rlike("|".join(words)), F.lit(number))
        return branches

    both = lambda k: let(F.concat_ws(" ", k, fold(title)), rule)
    return let(fold(kind), lambda k: F.coalesce(rule(k), both(k), F.lit(fixed.LEVEL_DEFAULT)))


def with_level(df: DataFrame, kind: str = "type", title: str = "title", out: str = "level") -> DataFrame:
    return df.withColumn(out, level(kind, title))


def _status(valid: bool, message: Column) -> Column:
    return F.struct(F.lit(valid).alias("is_valid"), message.alias("status"))


def marker_status(text: Column | str, reason_chars: int | None = None) -> Column:
    """Status from an in-text `(*) DEROGADO` style marker, null when there is none.

    The message quotes the text from the marker on to its end, or for `reason_chars` characters
    (`fixed.MARKER_REASON_CHARS` in the original).
    """
    def judged(t, hit):
        kind = F.when(F.upper(hit).contains("DEROGADO"), F.lit("DEROGADA")).otherwise("SIN EFECTO")
        reason = F.substring(t, F.instr(t, hit), F.lit(reason_chars) if reason_chars else F.length(t))
        return F.when(hit != "", _status(False, F.concat(kind, F.lit(": "), reason)))

    text = F.col(text) if isinstance(text, str) else text
    return let(text, lambda t: let(F.regexp_extract(t, "(?iuU)" + fixed.STATUS_MARKER, 0), lambda hit: judged(t, hit)))


def banner_status(
    html: Column | str,
    classes: list[tuple[str, str]] = fixed.BANNER_CLASSES,
    phrases: list[str] = fixed.BANNER_PHRASES,
    reason_chars: int | None = None,
) -> Column:
    """Status from page banners: elements of the listed classes whose text has a listed phrase.

    The page is cut at its tags; the text of an element runs to the tag that
    closes it, counting nested elements of the same name. The first hit by
    class order, then page order, gives the message, whole or its first `reason_chars`
    characters (`fixed.BANNER_REASON_CHARS` in the original).
    """
    html = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    tag_name = r"^</?([A-Za-z][A-Za-z0-9]*)"

    def tag_of(piece):
        return F.substring_index(piece, END, 1)

    def text_of(piece):
        return strip(decode_entities(F.element_at(F.split(piece, END), -1)))

    def class_rank(tag):
        value = F.concat(*[F.regexp_extract(tag, r"""(?i)\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", g) for g in (1, 2, 3)])

        def ranked(v):
            names = F.split(v, r"\s+")
            rank = F.when(F.lit(False), F.lit(None).cast("int"))
            for i, (how, name) in enumerate(classes):
                rank = rank.when(v.contains(name) if how == "part" else F.array_contains(names, name), F.lit(i))
            return rank

        return let(value, ranked)

    def element_text(pieces, pos, name):
        def step(acc, piece):
            same = F.lower(F.regexp_extract(tag_of(piece), tag_name, 1)) == name
            closes = same & piece.startswith("</")
            opens = same & ~piece.startswith("</")
            depth = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
            text = F.when(depth > 0, F.concat(acc["text"], text_of(piece))).otherwise(acc["text"])
            return F.when(acc["depth"] <= 0, acc).otherwise(F.struct(depth.alias("depth"), text.alias("text")))

        start = F.struct(F.lit(1).alias("depth"), text_of(F.get(pieces, pos)).alias("text"))
        rest = F.slice(pieces, pos + 2, F.size(pieces))
        return F.aggregate(rest, start, step)["text"]

    def first_hit(pieces):
        tagged = F.transform(
            pieces,
            lambda p, i: F.struct(F.when(p.rlike(r"^<[A-Za-z]"), class_rank(tag_of(p))).alias("rank"), i.alias("pos"),
                                  F.lower(F.regexp_extract(p, tag_name, 1)).alias("name")),
        )
        elements = F.transform(
            F.filter(tagged, lambda e: e["rank"].isNotNull()),
            lambda e: F.struct(e["rank"], e["pos"], element_text(pieces, e["pos"], e["name"]).alias("text")),
        )
        return F.array_min(F.filter(elements, lambda e: contains_any(F.lower(e["text"]), phrases)))["text"]

    visible = F.regexp_replace(F.translate(html, MARK + END, ""), SILENT, "")
    hit = let(F.split(F.regexp_replace(visible, TAG, MARK + "$0" + END), MARK), first_hit)
    reason = F.concat(F.lit("DEROGADA: "), F.substring(hit, 1, reason_chars) if reason_chars else hit)
    return F.when(hit.isNotNull(), _status(False, reason))


def norm_status(banner: Column, marker: Column, error: Column | None = None, error_chars: int | None = None) -> Column:
    """Banner first, then marker, else in force; a row with an error counts as in force.

    The error is given whole or for `error_chars` characters (`fixed.ERROR_REASON_CHARS` in the original).
    """
    def of(b, m):
        return (
            F.when(b.isNotNull(), F.struct(b["is_valid"], b["status"], F.lit("banner").alias("outcome")))
            .when(m.isNotNull(), F.struct(m["is_valid"], m["status"], F.lit("marker").alias("outcome")))
            .otherwise(F.struct(F.lit(True).alias("is_valid"), F.lit("VIGENTE").alias("status"), F.lit("valid").alias("outcome")))
        )

    outcome = let(banner, lambda b: let(marker, lambda m: of(b, m)))
    if error is None:
        return outcome
    failed = F.struct(F.lit(True).alias("is_valid"), F.concat(F.lit("ERROR: "), F.substring(error, 1, error_chars) if error_chars else error).alias("status"),
                      F.lit("error").alias("outcome"))
    return F.when(present(error).isNotNull(), failed).otherwise(outcome)


def has_repeal_note(block: Column) -> Column:
    return block.rlike("(?iuU)" + fixed.REPEAL_NOTE)


def without_note(block: Column, fallback_chars: int | None = None) -> Column:
    """Body before the first `(*)`; a body of under `fixed.MIN_BODY_CHARS` falls back to the block, or its opening of `fallback_chars` (300 in the original)."""
    body = strip(F.regexp_replace(block, "(?sU)" + fixed.NOTE_TAIL, ""))
    opening = F.substring(block, 1, fallback_chars) if fallback_chars else block
    return let(body, lambda b: F.when(F.length(b) < fixed.MIN_BODY_CHARS, opening).otherwise(b))


def label_article(df: DataFrame, block: str = "block", text_chars: int | None = None, raw_chars: int | None = None,
                  fallback_chars: int | None = None) -> DataFrame:
    """Adds label (1 in force, 0 repealed), text (note removed) and raw_text.

    Texts are whole unless a number of characters is given; the original dataset
    has `fixed.SAMPLE_TEXT_CHARS`, `fixed.SAMPLE_RAW_CHARS` and `fixed.FALLBACK_BODY_CHARS`.
    """
    b = F.col(block)
    cut = lambda c, n: F.substring(c, 1, n) if n else c
    return df.select(
        "*",
        F.when(has_repeal_note(b), 0).otherwise(1).alias("label"),
        cut(without_note(b, fallback_chars), text_chars).alias("text"),
        cut(b, raw_chars).alias("raw_text"),
    ).drop(block)
