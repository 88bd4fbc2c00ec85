"""Dataset preparation: balancing, splits, folds, class counts and weights."""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.skew import hash_rank


def seeded_digest(id: str, seed: int = 42) -> Column:
    """Reproducible order of rows: the same id and seed give the same digest in any engine."""
    return F.md5(F.concat(F.col(id).cast("string"), F.lit(f"|{seed}")))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, weight = n / (classes * n_c)."""
    counts = class_counts(df, label)
    total, classes = (counts.select(f).scalar() for f in (F.sum("n"), F.count(F.lit(1))))
    return counts.select(label, (total / (classes * F.col("n"))).alias("weight"))


def keep_common_classes(df: DataFrame, label: str, at_least: int = 5, low: int | None = None, high: int | None = None) -> DataFrame:
    """Rows of classes with enough rows; for numeric classes also within [low, high]."""
    rows = df if low is None else df.where(F.col(label).between(low, high))
    common = class_counts(rows, label).where(F.col("n") >= at_least)
    return rows.join(F.broadcast(common.select(label)), label, "left_semi")


def stack(minority: DataFrame, majority: DataFrame) -> DataFrame:
    return minority.unionByName(majority)


def first_by_digest(df: DataFrame, label: str, digest: Column, quotas: dict, width: int = 3) -> Column | None:
    """Whether a row is one of the first of its class by digest, as many as `quotas` has for the class; None where rows of equal digest are parted by that.

    Rows stay where they are: classes are counted by digest prefix, and only digests of the prefix in which a quota
    ends are ranked, a row in 16**width.
    """
    rows = df.select(F.col(label).alias("label"), digest.alias("digest")).where(F.col("digest").isNotNull() & F.col("label").isin(list(quotas)))
    sizes = rows.groupBy("label", F.substring("digest", 1, width).alias("bucket")).count().collect()
    ends = []
    for name, quota in quotas.items():
        upto, last = 0, None
        for bucket, n in sorted((r["bucket"], r["count"]) for r in sizes if r["label"] == name):
            if upto + n > quota:
                ends.append((name, bucket, quota - upto))
                break
            upto, last = upto + n, bucket
        else:
            ends.append((name, None, 0))
    within = [(n, b, k) for n, b, k in ends if b is not None and k > 0]
    cuts = {}
    if within:
        spark = df.sparkSession
        wanted = spark.createDataFrame([(b, k, i) for i, (_, b, k) in enumerate(within)], "bucket string, k long, place int")
        place = F.coalesce(*[F.when((F.col("label") == n) & F.col("digest").startswith(b), i) for i, (n, b, _) in enumerate(within)])
        near = rows.select("digest", place.alias("place")).where(F.col("place").isNotNull())
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy("digest")))
        found = ranked.join(F.broadcast(wanted), "place").where(F.col("rank").between(F.col("k"), F.col("k") + 1)).select("place", "digest").collect()
        for i, (name, _, _) in enumerate(within):
            digests = sorted(r["digest"] for r in found if r["place"] == i)
            if len(set(digests)) < len(digests):
                return None
            cuts[name] = digests[0]
    first = F.lit(False)
    for name, bucket, k in ends:
        inside = digest.isNotNull() if bucket is None else digest <= cuts[name] if k > 0 else F.substring(digest, 1, width) < bucket
        first = first | ((F.col(label) == name) & inside)
    return first


def balance(df: DataFrame, label: str, id: str, ratio: float = 1.5, seed: int = 42, minority: int = 0, majority: int = 1) -> DataFrame:
    """All minority rows and a seeded choice of int(ratio * minority) majority rows. Only counts move, unless rows of one id are parted."""
    few = df.where(F.col(label) == minority)
    quota = floor(few.count() * ratio)
    digest = seeded_digest(id, seed)
    first = first_by_digest(df, label, digest, {majority: quota})
    if first is not None:
        return df.where((F.col(label) == minority) | F.coalesce(first, F.lit(False)))
    many = hash_rank(df.where(F.col(label) == majority), digest, at_most=F.lit(quota)).drop("rank")
    return stack(few, many.select(*df.columns))


def test_quotas(df: DataFrame, label: str, share: float) -> DataFrame:
    """label, quota: ceil(share * n) test rows spread over the classes by largest remainder."""
    counts = class_counts(df, label)
    whole = Window.partitionBy()
    sized = counts.withColumn("_total", F.sum("n").over(whole)).withColumn("_test", F.ceil(F.col("_total") * share))
    exact = sized.withColumn("_exact", F.col("_test") * F.col("n") / F.col("_total")).withColumn("_low", F.floor("_exact"))
    spare = F.col("_test") - F.sum("_low").over(whole)
    place = F.row_number().over(Window.orderBy(F.desc(F.round(F.col("_exact") - F.col("_low"), 9)), label))
    return exact.withColumn("_spare", spare).withColumn("_place", place).select(
        label, (F.col("_low") + (F.col("_place") <= F.col("_spare")).cast("int")).alias("quota")
    )


def stratified_split(df: DataFrame, label: str, id: str, share: float = 0.15, seed: int = 42, exact: bool = False) -> DataFrame:
    """Adds `part`, train or test. By hash each row decides alone; `exact` meets the class quotas to the row, and only counts move, unless rows of one id are parted."""
    digest = seeded_digest(id, seed)
    if not exact:
        point = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(16**8))
        return df.withColumn("part", F.when(point < share, "test").otherwise("train"))
    quotas = test_quotas(df, label, share)
    first = first_by_digest(df, label, digest, dict(quotas.where(F.col(label).isNotNull()).collect()))
    if first is not None:
        part = F.when(first, "test").otherwise("train")
        return df.where(digest.isNotNull() & F.col(label).isNotNull()).withColumn("part", part)
    ranked = hash_rank(df, digest, by=[label])
    part = F.when(F.col("rank") <= F.col("quota"), "test").otherwise("train")
    return ranked.join(F.broadcast(quotas), label).withColumn("part", part).select(*df.columns, "part")


def stratified_folds(df: DataFrame, label: str, id: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds `fold`, 0 to folds - 1, dealt out in turn within each class."""
    ranked = hash_rank(df, seeded_digest(id, seed), by=[label])
    return ranked.withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(folds)).cast("int")).select(*df.columns, "fold")


def folds_of_part(parts: DataFrame, label: str, id: str, part: str = "train", folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds `fold` to the rows of a part, dealt out in turn within each class; it is -1 for all others."""
    dealt = stratified_folds(parts.where(F.col("part") == part), label, id, folds, seed)
    return dealt.unionByName(parts.where(F.col("part") != part).withColumn("fold", F.lit(-1)))


def require_rows(df: DataFrame, n: int = 20) -> None:
    """Refuse to go on with fewer than `n` rows; reads no further than that."""
    found = df.limit(n).count()
    if found < n:
        raise ValueError(f"needs at least {n} rows, found {found}")
