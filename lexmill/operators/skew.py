"""Building blocks that keep hot keys spread over many tasks."""

from __future__ import annotations

from functools import reduce
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import let

BROADCAST_ROWS = 200_000
#: Rows of a task of costly work.
TASK_ROWS = 50_000


def spread(scan: DataFrame) -> DataFrame:
    """A scan that yields fewer tasks than there are cores, or than its rows call for, is dealt out; a larger one stays as it is.

    For work that costs far more per row than moving the row, on input of few files. A row made of
    short columns may hold much work, so tasks are counted by rows: no task grows with the table.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, ceil(scan.count() / TASK_ROWS))
    return scan.repartition(tasks) if scan.rdd.getNumPartitions() < tasks else scan


def order_slices(df: DataFrame, col: str, n: int | None = None) -> Column:
    """Slice number that grows with a numeric or time column and cuts the rows into about equal parts.

    There are as many slices as shuffle partitions (64 at least), so one hot key
    still fills every task. The cuts are looked up in two steps, among groups of
    cuts and then within one.
    """
    spark = df.sparkSession
    n = n or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    is_time = dict(df.dtypes)[col].startswith("timestamp")
    value = (F.col(col).cast("timestamp") if is_time else F.col(col)).cast("double")
    cuts = sorted(set(df.select(value.alias("v")).approxQuantile("v", [i / n for i in range(1, n)], 1 / (4 * n))))
    if not cuts:
        return F.lit(0)
    step = max(1, isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]

    def below(bounds: Column, v: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= v))

    firsts = F.array(*[F.lit(g[0]) for g in groups])
    all_groups = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
    within = lambda v, g: F.when(g == 0, 0).otherwise((g - 1) * step + below(F.get(all_groups, g - 1), v))
    return let(value, lambda v: let(below(firsts, v), lambda g: within(v, g)))


def lag_sliced(df: DataFrame, key: list[str], order: list[str], value: Column, slice_by: Column, out: str,
               attach: DataFrame | None = None) -> DataFrame:
    """The previous row's `value` within `key`, as a struct with field v, null on the first row.

    A plain `lag` sorts each key in one task. Here each key is cut into slices
    along the order; the last value of a slice is carried to the first row of
    the next through a table of one row per key and slice. Columns of `attach`
    (one row per key) travel with that table, so no join meets a hot key.
    A null key is a key like any other.
    """
    sliced = df.withColumn("_slice", slice_by)
    near = F.lag(F.struct(value.alias("v"))).over(Window.partitionBy(*key, "_slice").orderBy(*order))
    tails = sliced.groupBy(*key, "_slice").agg(F.max_by(F.struct(value.alias("v")), F.struct(*order)).alias("_tail"))
    far = F.lag("_tail").over(Window.partitionBy(*key).orderBy("_slice"))
    carried = tails.select(*key, "_slice", far.alias("_far"))
    if attach is not None:
        carried = carried.join(attach, key, "left")
    names = {k: f"_carried_{k}" for k in [*key, "_slice"]}
    carried = carried.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()])
    return (
        sliced.withColumn("_near", near)
        .join(carried, same, "left")
        .withColumn(out, F.coalesce("_near", "_far"))
        .drop("_near", "_far", "_slice", *names.values())
    )


def salted_join(rows: DataFrame, per_key: DataFrame, key: str, spread_by: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """Join rows, of which one key may hold very many, to a table of one row per key.

    Each key is cut into `salts` parts by a hash of `spread_by`, and the one-row side is repeated for each part.
    """
    cut = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return cut.join(repeated, [key, "_salt"], how).drop("_salt")


def hash_rank(df: DataFrame, digest: Column, by: list[str] = (), out: str = "rank", width: int = 3,
              at_most: Column | None = None) -> DataFrame:
    """Exact rank by a hex digest, overall or within `by`, without one task sorting a whole group.

    Rows are ranked inside buckets of equal digest prefix (16**width of them) and
    shifted by the number of rows in earlier buckets. With `at_most` only the
    first rows are kept, and buckets past that point are dropped before ranking.
    The overall offsets are at most 16**width rows, so they are broadcast.
    """
    by = list(by)
    marked = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, width))
    sizes = marked.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*by).orderBy("_bucket")) - F.col("_n")
    offsets = sizes.select(*by, "_bucket", earlier.alias("_off"))
    placed = marked.join(offsets if by else F.broadcast(offsets), [*by, "_bucket"])
    if at_most is not None:
        placed = placed.where(F.col("_off") < at_most)
    inside = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_digest"))
    ranked = placed.withColumn(out, F.col("_off") + inside)
    if at_most is not None:
        ranked = ranked.where(F.col(out) <= at_most)
    return ranked.drop("_digest", "_bucket", "_off")


def first_by(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key by an order, as a partial aggregate instead of a window."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")
