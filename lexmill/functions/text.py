"""Column functions on text: whitespace, accents, hashes, links, dates, display forms."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = r"(?U)\s+"
OUTER_WHITESPACE = r"(?U)^\s+|(?<!\s)\s+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and pass it to `body`."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (`trim` removes spaces only); the pattern goes over texts that still end in some."""

    def rest(t):
        edges = [F.left(t, F.lit(1)), F.right(t, F.lit(1))]
        return F.when(edges[0].rlike(r"(?U)\s") | edges[1].rlike(r"(?U)\s"), F.regexp_replace(t, OUTER_WHITESPACE, "")).otherwise(t)

    return let(F.trim(_col(c)), rest)


def squash(c: Column | str) -> Column:
    """Collapse every run of whitespace to one space."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE, " "))


@lru_cache(maxsize=1)
def _accent_pairs() -> tuple[str, str]:
    """Letters that decompose to one base letter plus marks, with that base letter."""
    accented, plain = [], []
    for code in range(0xC0, 0x1F00):
        char = chr(code)
        rest = [x for x in unicodedata.normalize("NFD", char) if unicodedata.category(x) != "Mn"]
        if len(rest) == 1 and rest[0] != char:
            accented.append(char)
            plain.append(rest[0])
    return "".join(accented), "".join(plain)


def fold(c: Column | str) -> Column:
    """Lower-case without accents; null becomes the empty string."""
    accented, plain = _accent_pairs()
    lowered = F.lower(F.coalesce(_col(c), F.lit("")))
    return F.regexp_replace(F.translate(lowered, accented, plain), r"\p{Mn}+", "")


def content_hash(c: Column | str) -> Column:
    """SHA-256 of the text, null as empty."""
    return F.sha2(F.coalesce(_col(c), F.lit("")), 256)


def detail_url(doc_id: Column | str, base: str = "https://example.org/#/detallenorma/") -> Column:
    return F.concat(F.lit(base), _col(doc_id).cast("string"))


def url_tail(c: Column | str) -> Column:
    """Last segment of a link, after dropping trailing slashes."""
    return F.element_at(F.split(F.regexp_replace(_col(c), "/+$", ""), "/"), -1)


def present(c: Column | str) -> Column:
    """The value, or null when it is the empty string."""
    return F.nullif(_col(c), F.lit(""))


def pick_title(title: Column, summary: Column, number: Column, doc_id: Column, placeholder: str) -> Column:
    """Title, else summary; a placeholder or blank title goes to summary, number, id."""
    first = F.coalesce(present(title), present(summary))
    usable = F.when(first != placeholder, first)
    return F.coalesce(usable, present(summary), present(number), doc_id.cast("string"))


def safe_date(c: Column | str) -> Column:
    """A date, or null for text that is none."""
    return _col(c).try_cast("date")


def year_of(c: Column | str) -> Column:
    return F.year(_col(c))


def number_token(c: Column | str) -> Column:
    """First run of digits, or null."""
    return present(F.regexp_extract(_col(c), r"(\d+)", 1))


def _opening(c: Column, max_chars: int | None) -> Column:
    return c if max_chars is None else F.substring(c, 1, max_chars)


def embedding_text(kind: Column, number: Column, title: Column, clean: Column, max_chars: int | None = None) -> Column:
    """Type, number, title and the text, blanks skipped; `max_chars` (1,000 for the original encoder) takes its opening only."""
    numbered = F.concat(F.lit("N° "), present(number))
    return F.concat_ws(". ", present(kind), numbered, present(title), present(_opening(clean, max_chars)))


def classifier_text(title: Column, clean: Column, max_chars: int | None = None, kind: Column | None = None) -> Column:
    """Title and text; `max_chars` (2,500 for the original classifier) takes its opening only. `kind` gives the older form, which leaks the label."""
    parts = [] if kind is None else [present(kind)]
    return F.concat_ws(" ", *parts, present(title), present(_opening(clean, max_chars)))


def short_hash(c: Column | str, n: int = 10) -> Column:
    return F.when(F.length(_col(c)) > 0, F.concat(F.substring(_col(c), 1, n), F.lit("..."))).otherwise("")


def type_and_number(kind: Column | str, number: Column | str) -> Column:
    return F.trim(F.concat_ws(" ", F.coalesce(_col(kind), F.lit("")), F.coalesce(_col(number), F.lit(""))))


def iso_date(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def iso_time(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")


def snapshot(*cols: Column | str) -> Column:
    """The named columns as one JSON string, encoded once."""
    return F.to_json(F.struct(*cols))


def relabel(c: Column | str, names: dict) -> Column:
    """Replace codes by names; unknown codes stay as they are."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c)), _col(c).cast("string"))


def short_code_name(c: Column | str, n: int = 26) -> Column:
    return F.substring(F.initcap(F.replace(_col(c), F.lit("CODIGO"), F.lit("C."))), 1, n)


def mentions_repeal(c: Column | str) -> Column:
    lowered = F.lower(_col(c))
    return (lowered.contains("derog") | lowered.contains("sin efecto")).cast("int")
