"""HTML to text with Spark string functions only."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import strip

MARK = "\u0001"
# Comments, declarations and elements whose content is not text.
SILENT = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)|<[!?][^>]*>"
TAG = r"""</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
LOOSE_TAG = r"</?[A-Za-z][^>]*>"
NAME = r"^([^\t\n\f <&#;]{1,32});"
NUMBER = r"^#(?:0*([0-9]+)|[xX]0*([0-9A-Fa-f]+));?"
#: Names that also stand without a semicolon, longest first: of several that fit, the longest is meant.
LEGACY = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
COMMON = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "apos": "'"}


def _map(pairs: dict[str, str]) -> Column:
    """A fixed table as a map, from one literal that is folded to a constant."""
    joined = "\u0003".join(f"{name}\u0004{text}" for name, text in sorted(pairs.items()))
    return F.str_to_map(F.lit(joined), F.lit("\u0003"), F.lit("\u0004"))


def _named() -> Column:
    return _map({name[:-1]: text for name, text in html5.items() if name.endswith(";")})


def _legacy() -> Column:
    return _map({name: html5[name] for name in LEGACY})


def _windows(code: int) -> int:
    """What a number from 128 to 159 stands for on the web: the letter of Windows-1252, where there is one."""
    try:
        return ord(bytes([code]).decode("cp1252"))
    except UnicodeDecodeError:
        return code


def _from_code(code: Column) -> Column:
    """The character of a number; nothing for control characters and non-characters, U+FFFD for what is no character at all."""
    remapped = F.get(F.array(*[F.lit(_windows(c)) for c in range(128, 160)]), code - 128)
    none = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code % 65536 >= 0xFFFE)
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    safe = F.when(code.between(128, 159), remapped).when(valid, code).otherwise(0xFFFD)
    return F.when(none & valid, F.lit("")).otherwise(F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32"))


def decode_entities(c: Column) -> Column:
    """Character references to characters, as browsers read them; unknown names stay as written.

    Covers all names of the standard, names without their semicolon where that is
    allowed (the longest that fits), and numbers with their Windows-1252 reading.
    """

    def number(piece: Column) -> Column:
        decimal, hexadecimal = F.regexp_extract(piece, NUMBER, 1), F.regexp_extract(piece, NUMBER, 2)
        code = (
            F.when(F.length(decimal) > 7, 0x110000).when(F.length(hexadecimal) > 6, 0x110000)
            .when(decimal != "", decimal.cast("int")).otherwise(F.conv(hexadecimal, 16, 10).cast("int"))
        )
        return F.concat(_from_code(code), F.regexp_replace(piece, NUMBER, ""))

    def name(piece: Column) -> Column:
        full, short = F.regexp_extract(piece, NAME, 1), F.regexp_extract(piece, "^(?:" + "|".join(LEGACY) + ")", 0)
        common = F.coalesce(*[F.when(full == k, F.lit(v)) for k, v in COMMON.items()])
        char = F.coalesce(common, F.when(full != "", F.try_element_at(_named(), full)))
        after = F.substring(piece, F.length(full) + 2, F.length(piece))
        # A name that is also valid alone may be followed by the semicolon that ends it.
        shortened = F.concat(F.try_element_at(_legacy(), short), F.substring(piece, F.length(short) + 1, F.length(piece)))
        return F.coalesce(F.concat(char, after), F.when(short != "", shortened), F.concat(F.lit("&"), piece))

    one = lambda piece: F.when(piece.rlike(NUMBER), number(piece)).otherwise(name(piece))
    pieces = F.split(c, "&")
    decoded = F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one), ""))
    return F.when(c.contains("&"), decoded).otherwise(c)


def text_segments(c: Column) -> Column:
    """Text nodes in order: stripped, decoded, blanks dropped."""
    marked = F.regexp_replace(F.replace(c, F.lit(MARK), F.lit("")), SILENT, MARK)
    marked = F.regexp_replace(F.regexp_replace(marked, TAG, MARK), LOOSE_TAG, MARK)
    nodes = F.transform(F.split(marked, MARK), lambda s: strip(decode_entities(s)))
    return F.filter(nodes, lambda s: s != "")


def html_to_text(c: Column | str, sep: str = "\n", always: bool = False) -> Column:
    """Text of an HTML string. Unless `always`, text without both `<` and `>` is left alone; text without `<` is one node."""
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    text = F.array_join(text_segments(c), sep)
    node = strip(decode_entities(F.replace(c, F.lit(MARK), F.lit(""))))
    return F.when(c.contains("<"), text).otherwise(node) if always else F.when(c.contains("<") & c.contains(">"), text).otherwise(c)
