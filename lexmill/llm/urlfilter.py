"""URL rules with wildcards, all run at once as one bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import lower_ascii, query, table

#: Symbol between host and path; bytes are 0 to 255.
SEPARATOR = 256


class Rule(NamedTuple):
    """`host` and `path` are globs: ? is any one byte, * any run of bytes of that part."""

    name: str
    host: str
    path: str
    verdict: str


def site_rule(host: str, path: str, verdict: str) -> list[Rule]:
    """A rule for a host, all its subdomains and every path that starts with `path`."""
    return [Rule(host + path, h, path + "*", verdict) for h in (host, "*." + host)]


def parse_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def parse_path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class ShiftAnd:
    """Glob patterns over symbol sequences, packed into 64-bit words and advanced together.

    Bit i of a pattern means that its first i symbols are matched. A symbol c
    moves every bit with `(D << 1) & step[c] | D & loop[c]`: `step` lets a bit
    advance, `loop` lets it stay where the pattern has a *. Patterns may cross word
    borders; the bit shifted out of a word enters the next. All patterns are
    anchored at both ends.
    """

    def __init__(self, rules: Sequence[Rule]):
        tokens = [[*self._part(r.host), ({SEPARATOR}, False), *self._part(r.path)] for r in rules]
        starts = np.cumsum([0] + [sum(not star for _, star in t) + 1 for t in tokens])
        self.words = int(-(-starts[-1] // 64)) or 1
        self.step = np.zeros((SEPARATOR + 1, self.words), np.uint64)
        self.loop = np.zeros((SEPARATOR + 1, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.last = []
        for pattern, start in zip(tokens, starts):
            bit = int(start)
            self._set(self.first, bit)
            for symbols, star in pattern:
                bit += not star
                for c in symbols:
                    self._set((self.loop if star else self.step)[c], bit)
            self.last.append(bit)

    @staticmethod
    def _part(glob: str) -> Iterator[tuple[set[int], bool]]:
        any_byte = set(range(256))
        for char in glob:
            if char == "*":
                yield any_byte, True
            elif char == "?":
                yield any_byte, False
            else:
                yield from (({b}, False) for b in char.encode())

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << (bit % 64))

    def matches(self, hosts: Sequence[bytes], paths: Sequence[bytes]) -> np.ndarray:
        """Which pattern matches which URL, as a (URLs, patterns) table of booleans."""
        n = len(hosts)
        host_len = np.array([len(h) for h in hosts], np.int64)
        length = host_len + 1 + np.array([len(p) for p in paths], np.int64)
        symbols = np.frombuffer(b"".join(x for h, p in zip(hosts, paths) for x in (h, b"\0", p)), np.uint8).astype(np.int64)
        at = np.cumsum(length) - length
        symbols[at + host_len] = SEPARATOR
        order = np.argsort(-length, kind="stable")
        at, length = at[order], length[order]
        state = np.repeat(self.first[None], n, axis=0)
        one, top = np.uint64(1), np.uint64(63)
        # URLs that have ended drop off the end, as the longest come first.
        alive = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        for i, k in enumerate(alive):
            c, d = symbols[at[:k] + i], state[:k]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:k] = moved & self.step[c] | d & self.loop[c]
        found = np.empty((n, len(self.last)), bool)
        for j, bit in enumerate(self.last):
            found[order, j] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one == one
        return found


def judge_urls(df: DataFrame, url: str, rules: Sequence[Rule], defaults: Sequence[Rule] = (), batch: int = 4096) -> DataFrame:
    """`df` with host, path, rule and verdict (allow or block) for each URL; columns of these names are replaced.

    Of the matching `rules` the one with the longest name wins, the first among
    equals. Where none matches, rule is null and the verdict is that of the
    first matching rule of `defaults`, else allow; a URL without a host (also
    null, or without ://) is blocked unless a rule matches. Rules are judged on
    the host in lower case and on the path without query and fragment, at any length.
    """
    rules, defaults = list(rules), list(defaults)
    by_rank = sorted(rules, key=lambda r: -len(r.name)) + defaults
    n_rules = len(rules)

    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        automaton = ShiftAnd(by_rank)
        names = np.array([r.name for r in by_rank[:n_rules]] + [None], object)
        verdicts = np.array([r.verdict for r in by_rank] + ["allow", "block"], object)
        out = []
        for i in range(0, max(len(host), 1), batch):
            hosts = [h.encode() for h in host.iloc[i:i + batch]]
            found = automaton.matches(hosts, [p.encode() for p in path.iloc[i:i + batch]])
            none = len(by_rank) + np.array([not h for h in hosts], int)
            first = np.where(found.any(axis=1), found.argmax(axis=1), none) if by_rank else none
            out.append(pd.DataFrame({"rule": names[np.minimum(first, n_rules)], "verdict": verdicts[first]}))
        return pd.concat(out, ignore_index=True)

    judged = F.pandas_udf(judge, "rule string, verdict string")
    parsed = df.withColumns({"host": parse_host(F.col(url)), "path": parse_path(F.col(url))})
    return parsed.withColumn("_lexmill_judged", judged("host", "path")).withColumns(
        {"rule": F.col("_lexmill_judged.rule"), "verdict": F.col("_lexmill_judged.verdict")}).drop("_lexmill_judged")


RULES = [
    *site_rule("org", "/", "allow"),
    *site_rule("example.org", "/es/", "block"),
    *site_rule("example.org", "/en/1", "block"),
    *site_rule("com", "/fr/", "allow"),
    *site_rule("com", "/de/", "block"),
]
#: Pages without running text, judged where no rule above fits.
DEFAULTS = [
    Rule("ads", "ads.*", "*", "block"),
    Rule("login", "*", "*/login*", "block"),
    Rule("cart", "*", "*/cart/*", "block"),
    Rule("tag list", "*", "*/tag/*/page/*", "block"),
]


@query("op5_url_filter", """with u as (select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best as (select u.*, (select max_by(struct_pack(rule := h || p, v := v), length(h || p)) from r where (u.host = h or ends_with(u.host, '.' || h)) and starts_with(u.path, p)) as b from u)
select page_id, host, path, b.rule as rule, coalesce(b.v, case when host = '' or host like 'ads.%' or path like '%/login%' or path like '%/cart/%' or path like '%/tag/%/page/%' then 'block' else 'allow' end) as verdict from best""")
def op5_url_filter(spark, sf):
    """Every page's URL against the site rules, then the default globs."""
    return judge_urls(table(spark, sf, "pages").select("page_id", "url"), "url", RULES, DEFAULTS).select("page_id", "host", "path", "rule", "verdict")
