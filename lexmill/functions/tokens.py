"""Column functions that turn text into arrays of tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.fixed import TITLE_STOPWORDS
from lexmill.functions.text import WHITESPACE, let

WORD = r"(?U)\b\w\w+\b"
TITLE_WORD = r"(?U)\w[\w']*"


def _col(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def tokens_ws(c: Column | str) -> Column:
    """Lower-cased pieces between whitespace; punctuation stays on."""
    return F.array_remove(F.split(F.lower(_col(c)), WHITESPACE), "")


def tokens_words(c: Column | str) -> Column:
    """Lower-cased words of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD), 0)


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of an array of words, `low` to `high` words long."""
    grams = []
    for n in range(low, high + 1):
        parts = [F.slice(words, F.lit(i + 1), F.greatest(F.size(words) - (n - 1), F.lit(0))) for i in range(n)]
        gram = parts[0]
        for nxt in parts[1:]:
            gram = F.zip_with(gram, nxt, lambda a, b: F.concat(a, F.lit(" "), b))
        grams.append(gram)
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def tokens_ngrams(c: Column | str, low: int = 1, high: int = 2) -> Column:
    return let(tokens_words(c), lambda words: ngrams(words, low, high))


def title_words(c: Column | str, stopwords: list[str] | None = None) -> Column:
    """Words of a title without stopwords; repeats stay."""
    words = F.regexp_extract_all(F.lower(_col(c)), F.lit(TITLE_WORD), 0)
    return F.filter(words, lambda w: ~w.isin(stopwords or TITLE_STOPWORDS))


def term_counts(tokens: Column) -> Column:
    """(term, tf) of one document as an array: the tokens sorted, then cut where the term changes."""

    def cut(s, starts):
        last = lambda j: F.coalesce(F.get(starts, j + 1), F.size(s))
        return F.transform(starts, lambda p, j: F.struct(F.get(s, p).alias("term"), (last(j) - p).cast("long").alias("tf")))

    def runs(s):
        places = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(places, lambda starts: cut(s, starts))

    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), runs))
