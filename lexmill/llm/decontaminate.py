"""Benchmark decontamination by winnowed fingerprints, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import let
from lexmill.llm.common import lower_ascii, query, table, text_key, without
from lexmill.session import stage

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a passage that counts as taken from the benchmark, and of a fingerprinted k-gram.
WINDOW, GRAM = 10, 4
#: Benchmark fingerprints sent to every task at once: 8 bytes each. A larger set is met part by part.
BROADCAST_ROWS = 2_000_000
_LOW = (1 << 32) - 1


def words(text: Column) -> Column:
    """Words of the whole text, A-Z lower-cased: runs of 0-9, a-z and everything beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def _shifted(a: Column, by: Column | int) -> Column:
    return F.slice(a, F.lit(by) + 1, F.greatest(F.size(a) - by, F.lit(0)))


def _with_shifted(values: Column, by: int, join) -> Column:
    """`join` of each value and the one `by` places after it."""
    return let(values, lambda v: let(_shifted(v, by), lambda rest: F.zip_with(F.slice(v, F.lit(1), F.size(rest)), rest, join)))


def _doubled(values: Column, width: int, join) -> Column:
    """`join` over every `width` consecutive values, by doubling: 1, 2, 4 ... values and then an overlapping pair."""
    have = 1
    while have < width:
        by = min(have, width - have)
        values = _with_shifted(values, by, join)
        have += by
    return values


def winnow(tokens: Column, window: int = WINDOW, k: int = GRAM) -> Column:
    """Selected fingerprints of `tokens` as longs: 32 bits of the hash above 32 bits of the word position.

    Of every window - k + 1 consecutive k-grams the one with the smallest hash is kept, the first
    among equals, so any `window` words that two texts share contain a k-gram kept in both.
    """
    k = min(k, window)
    grams = _doubled(F.transform(tokens, lambda w: F.xxhash64(w)), k, lambda a, b: F.xxhash64(a, b))
    packed = F.transform(grams, lambda h, i: h.bitwiseAND(F.lit(~_LOW)).bitwiseOR(i.cast("long")))
    return F.array_distinct(_doubled(packed, window - k + 1, lambda a, b: F.least(a, b)))


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, 32)


def _position_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_LOW)).cast("int")


def _benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """item, length, content of each window of each item; an item shorter than a window is one."""
    tokens = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("w") - length + 1)
    return tokens.withColumn("length", length).withColumn("start", F.explode(starts)).select(
        "item", "length", F.concat_ws(" ", F.slice("w", F.col("start"), F.col("length"))).alias("content"))


def _marks(windows: DataFrame, length: int, window: int, k: int) -> DataFrame:
    """Distinct hashes that winnowing keeps of the windows of one length."""
    own = windows.where(F.col("length") == length).select("content").distinct()
    kept = own.select(F.explode(winnow(F.split("content", " "), length, k if length == window else length)).alias("fp"))
    return kept.select(_hash_of(F.col("fp")).alias("hash")).distinct()


def find_contamination(docs: DataFrame, id: str, text: str, benchmark: DataFrame, item: str, item_text: str,
                       window: int = WINDOW, k: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated, text_key: one row for each row of `docs`.

    A document's kept fingerprints are looked up among those of the benchmark.
    Each hit is extended to the windows around it, which are compared with
    the benchmark's windows word by word. Every occurrence of a window is found,
    as its own minimum is kept on both sides. Items shorter than a window
    are looked up by one fingerprint of all their words.

    The documents are read once; only rows for hits leave the scan. Benchmark
    fingerprints are broadcast in parts of at most `broadcast_rows`, one read of
    the documents for each part. Window contents meet in a shuffle join of hits.
    Null or blank texts have no words and are clean. An item with a null id
    hits but is not listed; repeated items count once. Rows sharing an id are
    judged each by itself. An empty benchmark leaves every document clean.
    """
    windows = stage(_benchmark_windows(benchmark, item, item_text, window), "benchmark-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most `window` numbers
    marks = {n: stage(_marks(windows, n, window, k), "benchmark-marks") for n in lengths}

    rows = docs.select(
        F.col(id).alias("id"), F.monotonically_increasing_id().alias("row"), text_key(id, text).alias("text_key"), words(F.col(text)).alias("w"))
    hits = [rows.select("row", "id", "text_key", F.size("w").cast("long").alias("n_words"), F.lit(None).cast("int").alias("length"),
                        F.array().cast("array<struct<start:int,content:string>>").alias("around"))] if not lengths else []
    for n in lengths:
        parts = max(1, -(-marks[n].count() // broadcast_rows))
        for part in range(parts):
            some = marks[n].where(F.pmod(F.xxhash64("hash"), F.lit(parts)) == part) if parts > 1 else marks[n]
            hits.append(_hits(rows, some, n, k if n == window else n))
    found = hits[0]
    for more in hits[1:]:
        found = found.union(more)
    found = stage(found, "hits")

    places = found.select("row", "length", F.explode("around").alias("p")).select("row", "length", "p.start", "p.content").distinct()
    taken = stage(places.join(windows.select("content").distinct(), "content"), "taken")
    covered = F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("start", "length")), lambda s: F.sequence(s.start, s.start + s.length - 1))))
    n_hit = taken.groupBy("row").agg(F.size(covered).cast("long").alias("n_hit"))
    pairs = taken.select("row", "content").distinct().join(windows.select("content", "item").distinct(), "content")
    listed = F.array_sort(F.collect_set(F.col("item").cast("string")))
    items = pairs.groupBy("row").agg(listed.alias("items"))
    base = found.where(F.col("length").isNull()).select("row", "id", "text_key", "n_words").distinct()
    n = F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.join(n_hit, "row", "left").join(items, "row", "left").select(
        F.col("id").alias(id), "n_words", n.alias("n_hit"),
        F.coalesce(F.size("items").cast("long"), F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias("items_sha256"),
        (n > 0).alias("contaminated"), "text_key")


def drop_contaminated(docs: DataFrame, id: str, text: str, benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """Rows of `docs` that hold no window of the benchmark, with all their columns."""
    found = find_contamination(docs, id, text, benchmark, item, item_text)
    gone = found.where("contaminated").select(F.col(id).alias("id"), "text_key")
    return without(docs, stage(gone, "contaminated"), id, text)


def _hits(rows: DataFrame, marks: DataFrame, n: int, k: int) -> DataFrame:
    """One row per document (length null), and one per kept fingerprint that is also in `marks`, with the windows around it."""
    kept = rows.withColumn("fp", F.concat(F.array(F.lit(None).cast("long")), winnow(F.col("w"), n, k)))
    each = kept.select("row", "id", "text_key", "w", F.explode("fp").alias("fp"))
    known = F.broadcast(marks.withColumn("known", F.lit(True)))
    met = each.withColumn("hash", _hash_of(F.col("fp"))).join(known, "hash", "left").where("fp is null or known")
    at = F.coalesce(_position_of(F.col("fp")), F.lit(0))
    first = F.greatest(at - (n - k), F.lit(0))
    last = F.greatest(F.least(at, F.size("w") - n), first)
    around = F.transform(F.sequence(first, last), lambda s: F.struct(
        s.alias("start"), F.concat_ws(" ", F.slice("w", s + 1, F.lit(n))).alias("content")))
    return met.select(
        "row", "id", "text_key", F.size("w").cast("long").alias("n_words"), F.when(F.col("fp").isNotNull(), F.lit(n)).alias("length"),
        F.when(F.col("fp").isNotNull(), around).otherwise(F.array().cast("array<struct<start:int,content:string>>")).alias("around"))


_SPLIT_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION_SQL = f"""with d as (select doc_id, {_SPLIT_SQL} as w from documents),
b as (select item_id, {_SPLIT_SQL} as w from benchmark),
bw as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') as c from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) as s from b where len(w) > 0)),
dw as (select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as c from (select d.*, n, unnest(range(1, len(w) - n + 2)) as s from d cross join (select distinct n from bw))),
hit as (select doc_id, s, n, c from dw where c in (select c from bw)),
cover as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from hit) group by 1),
items as (select doc_id, list(distinct item_id::varchar order by item_id::varchar) as l from (select distinct doc_id, c from hit) join bw using (c) group by 1)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(l), 0) as n_items, sha256(coalesce(array_to_string(l, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join cover using (doc_id) left join items using (doc_id)"""


@query("op2_decontamination", CONTAMINATION_SQL)
def op2_decontamination(spark, sf):
    """Words of every document that lie in passages of ten benchmark words."""
    return find_contamination(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "benchmark"), "item_id", "text").drop("text_key")
