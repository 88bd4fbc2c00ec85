"""Connected components of a large graph by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import stage

MAX_ROUNDS = 200


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) for every node of a link; nulls and self-links are passed over.

    Large-star and small-star steps in turn: each node hands its larger, then its
    smaller neighbours to the smallest one, until nothing changes (about log n
    rounds). A step is a minimum per node, summed before the shuffle, and a join
    back, which Spark splits where a node is hot. Each round is written under the
    shared folder, so a lost executor repeats one round at most, and only a count
    and a checksum of it come to the driver.
    """
    u, v = F.col("u"), F.col("v")
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = stage(ends.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (u != v)).distinct(), "links")
    before = _state(pairs)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = pairs.select("u", "v").union(pairs.select(v.alias("u"), u.alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where(v > u).join(lowest, "u").select(v.alias("u"), F.col("m").alias("v"))
        large = large.union(both.where(v < u).groupBy("u").agg(F.min("v").alias("v"))).where(u != v).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        pairs = stage(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(u.alias("node"), v.alias("component")).union(pairs.select(v, v).distinct())
