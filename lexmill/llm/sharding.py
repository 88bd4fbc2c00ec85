"""Reproducible shuffle into shards: a Feistel permutation of the global row numbers."""

from __future__ import annotations

import random
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import let
from lexmill.llm.common import number_rows, query, table

ROUND_PAIRS = 3
#: Enough for any walk: see `permuted`.
MAX_WALK = 64


def round_keys(seed: int, pairs: int = ROUND_PAIRS) -> list[tuple[int, int, int, int]]:
    """(addend, odd factor) for each half of each pair of rounds, below 2**29."""
    rng = random.Random(seed)
    return [tuple(v for _ in range(2) for v in (rng.getrandbits(29), rng.getrandbits(28) * 2 + 1)) for _ in range(pairs)]


def sides(n: int) -> tuple[int, int]:
    """Moduli a, b of the two halves, a * b >= n and a * b - n < a."""
    a = isqrt(max(n - 1, 0)) + 1
    return a, -(-max(n, 1) // a)


def _mix(v: Column, addend: Column, factor: Column) -> Column:
    return let((v + addend) * factor, lambda t: F.shiftrightunsigned(t, 13).bitwiseXOR(t))


def _once(x: Column, n: int, seed: int) -> Column:
    """One pass of the Feistel network on the pair (x div b, x mod b), a bijection of 0 .. a*b-1."""
    a, b = sides(n)
    keys = F.array(*[F.struct(*[F.lit(v).cast("long").alias(f"k{i}") for i, v in enumerate(k)]) for k in round_keys(seed)])

    def pair(s: Column, k: Column) -> Column:
        return let((s.l + _mix(s.r, k.k0, k.k1)) % F.lit(a), lambda left: F.struct(
            left.alias("l"), ((s.r + _mix(left, k.k2, k.k3)) % F.lit(b)).alias("r")))

    right = x % F.lit(b)
    start = F.struct(((x - right) / F.lit(b)).cast("long").alias("l"), right.alias("r"))
    return F.aggregate(keys, start, pair, lambda s: s.l * F.lit(b) + s.r)


def permuted(row: Column, n: int, seed: int) -> Column:
    """Place of row number `row` (0 .. n-1) in a shuffle of n rows; needs no data but n and the seed.

    The network permutes a*b >= n numbers; a number of n or more is permuted
    again (cycle walking). Fewer than a numbers lie beyond n, so a walk is shorter than
    `MAX_WALK` = 64 for n up to 4,096; for larger n one step leaves the range with
    chance below 1/64, and 64 steps in a row do not happen. A longer walk would
    stop the job with an error rather than give a wrong place.
    """
    step = lambda y: _once(y, n, seed)
    walk = lambda y: F.aggregate(F.sequence(F.lit(1), F.lit(MAX_WALK)), y, lambda z, _: F.when(z < n, z).otherwise(step(z)))
    return let(let(step(row.cast("long")), lambda y: F.when(y < n, y).otherwise(walk(y))),
               lambda y: F.when(y < n, y).otherwise(F.raise_error(F.lit("walk too long")).cast("long")))


def assign_shards(df: DataFrame, order: list[str], n_shards: int = 16, seed: int = 42) -> DataFrame:
    """`df` with shard (0 .. n_shards-1) and slot (gapless from 0 within a shard); shard sizes differ by one at most.

    Rows are numbered in the order of `order`, which should be a key with small
    tie-breakers; the number is permuted, shard = place mod n_shards and
    slot = place div n_shards. The same rows give the same places on any
    cluster. Pass small columns only and join texts by key afterwards. Rows
    equal in all of `order` (repeated rows) take different places; which takes
    which does not show. Nulls count as smallest. Empty input gives no rows.
    """
    numbered, n = number_rows(df, order, "_lexmill_row")
    place = permuted(F.col("_lexmill_row"), n, seed)
    return numbered.withColumn("_lexmill_place", place).withColumns({
        "shard": (F.col("_lexmill_place") % n_shards).cast("int"),
        "slot": ((F.col("_lexmill_place") - F.col("_lexmill_place") % n_shards) / n_shards).cast("long"),
    }).drop("_lexmill_row", "_lexmill_place")


def _places_sql(n_shards: int, seed: int) -> str:
    """The same permutation in SQL: rounds as nested selects, the walk as a recursion."""
    mix = lambda v, add, mul: f"xor((({v} + {add}) * {mul}) >> 13, ({v} + {add}) * {mul})"

    def network(source: str) -> str:
        sql = f"select row, a, b, n, x // b as l, x % b as r from {source}"
        for k0, k1, k2, k3 in round_keys(seed):
            sql = f"select row, a, b, n, (l + {mix('r', k0, k1)}) % a as l, r from ({sql})"
            sql = f"select row, a, b, n, l, (r + {mix('l', k2, k3)}) % b as r from ({sql})"
        return f"select row, a, b, n, l * b + r as x from ({sql})"

    return f"""numbered as (select doc_id, size, text_crc32, row_number() over (order by doc_id nulls first, text_crc32, size) - 1 as row from sized),
sides as (select n, a, (n + a - 1) // a as b from (select count(*) as n, ceil(sqrt(count(*)))::bigint as a from sized)),
start as (select row, row as x, a, b, n from numbered cross join sides),
walk as ({network("start")} union all {network("(select * from walk where x >= n)")}),
placed as (select row, x from walk where x < n)
select doc_id, size, text_crc32, 'rows' as law, (x % {n_shards})::int as shard, x // {n_shards} as slot, null::int as grown_shard from numbered join placed using (row)"""


#: CRC-32 in SQL, byte by byte with the usual table of 256 remainders.
_SIZED_SQL = """crc as (select list(c order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) as c from range(256) r(i))),
raw as (select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint) as bytes from documents),
sized as (select doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32 from raw cross join crc)"""


@query("op7_sharding", f"with recursive {_SIZED_SQL}, {_places_sql(16, 42)}")
def op7_sharding(spark, sf):
    """All documents in 16 shards by the law `rows`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = assign_shards(slim, ["doc_id", "text_crc32", "size"], 16, 42)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
