"""Versioned ingest: limits, change points, merge, child rows, sampling, validation."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill import fixed, schemas
from lexmill.functions.text import present
from lexmill.operators.skew import first_by, hash_rank, lag_sliced, order_slices, salted_join
from lexmill.session import stage


# --- Fields -------------------------------------------------------------------

def truncate_fields(df: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Cut strings to their limits and add `cut_fields`, the number of fields cut in the row."""
    limits = {k: v for k, v in (limits or fixed.FIELD_LIMITS).items() if k in df.columns}
    over = [F.coalesce((F.length(c) > n).cast("int"), F.lit(0)) for c, n in limits.items()]
    counted = df.withColumn("cut_fields", reduce(lambda a, b: a + b, over, F.lit(0)))
    return counted.withColumns({c: F.substring(c, 1, n) for c, n in limits.items()})


def fill(df: DataFrame, defaults: dict) -> DataFrame:
    """Nulls replaced by the given values."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


# --- Filters ------------------------------------------------------------------

def keep_valid(df: DataFrame, level: int | None = None, valid: str = "is_valid", level_col: str = "level") -> DataFrame:
    out = df.where(F.col(valid) == 1)
    return out if level is None else out.where(F.col(level_col) == level)


def keep_sized(df: DataFrame, text: str, max_chars: int) -> DataFrame:
    """Texts of one character up to `max_chars` (in the sampling collector `fixed.MAX_TEXT_CHARS`)."""
    return df.where(F.length(text).between(1, max_chars))


def skip_known(df: DataFrame, known: DataFrame, id: str) -> DataFrame:
    """Rows whose id was not collected before."""
    return df.join(known.select(id), id, "left_anti")


def first_seen(df: DataFrame, id: str, order: list[str]) -> DataFrame:
    """The first row of each id across groups."""
    return first_by(df, [id], order)


def keep_new_ids(df: DataFrame, id: str, order: list[str], known: DataFrame | None = None) -> DataFrame:
    """Blank ids dropped, repeats dropped, ids already known dropped."""
    out = first_seen(df.where(present(F.col(id).cast("string")).isNotNull()), id, order)
    return out if known is None else skip_known(out, known, id)


def pending(df: DataFrame, force: bool = False, date: str = "validation_date", valid: str = "is_valid") -> DataFrame:
    """Rows still to validate; all of them when forced."""
    return df if force else df.where(F.col(date).isNull() | F.col(valid).isNull())


def drop_invalid(df: DataFrame, valid: str = "is_valid") -> DataFrame:
    """Invalid rows dropped; rows without a flag stay."""
    return df.where(F.coalesce(F.col(valid).cast("boolean"), F.lit(True)))


def drop_counts(df: DataFrame, valid: str = "is_valid") -> DataFrame:
    """How many rows `drop_invalid` keeps and drops."""
    bad = ~F.coalesce(F.col(valid).cast("boolean"), F.lit(True))
    return df.agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("dropped"))


# --- Versions -----------------------------------------------------------------

def latest_version(norms: DataFrame, versions: DataFrame, id: str = "id", fk: str = "norm_id",
                   date: str = "version_date", version_id: str = "id", cols: list[str] = ("raw_text",)) -> DataFrame:
    """Each norm with the named columns of its newest version, null where it has none."""
    newest = versions.groupBy(F.col(fk).alias(id)).agg(
        F.max_by(F.struct(*cols), F.struct(date, version_id)).alias("_v")
    )
    return norms.join(newest, id, "left").select(*norms.columns, *[F.col(f"_v.{c}").alias(c) for c in cols])


def versions_with_norms(versions: DataFrame, norms: DataFrame, fk: str = "norm_id", id: str = "id") -> DataFrame:
    return versions.alias("v").join(norms.alias("n"), F.col(f"v.{fk}") == F.col(f"n.{id}"))


def version_state(versions: DataFrame, fk: str = "norm_id", date: str = "version_date", version_id: str = "id") -> DataFrame:
    """`Inicial` on the first version of a norm, `Modificado` on later ones.

    The first version ids are one per norm and unique, so the join key is never hot.
    """
    firsts = versions.groupBy(fk).agg(F.min_by(version_id, F.struct(date, version_id)).alias(version_id))
    firsts = firsts.select(version_id, F.lit(True).alias("_first"))
    state = F.when(F.col("_first"), "Inicial").otherwise("Modificado")
    return versions.join(firsts, version_id, "left").withColumn("state", state).drop("_first")


def change_points(df: DataFrame, key: list[str], seq: list[str], value: str, slices: Column | None = None) -> DataFrame:
    """Rows whose value differs from the one before under the same key; the first row of a key counts."""
    slices = order_slices(df, seq[0]) if slices is None else slices
    prev = lag_sliced(df, key, seq, F.col(value), slices, "_prev")
    return prev.where(F.col("_prev").isNull() | ~F.col("_prev.v").eqNullSafe(F.col(value))).drop("_prev")


class Merge(NamedTuple):
    """The next state of both tables, what became of each item, and the rows by which the state differs from the last."""

    norms: DataFrame
    versions: DataFrame
    outcomes: DataFrame
    changed_norms: DataFrame
    new_versions: DataFrame


#: Fields that name a norm or its text; cut, they would make different norms or texts equal.
UNCUT = ("url", "text_hash")


META = ["type", "number", "title", "date", "source", "status", "text_hash", "level"]


def merge_outcomes(norms: DataFrame, batch: DataFrame, key: str = "url", seq: str = "seq", hash: str = "text_hash",
                   slices: Column | None = None) -> DataFrame:
    """The batch with `norm_id` (null for new keys) and `outcome`: added, updated or unchanged, item by item."""
    slices = order_slices(batch, seq) if slices is None else slices
    known = norms.select(key, F.col("id").alias("norm_id"), F.col("last_hash").alias("_known"))
    items = lag_sliced(batch, [key], [seq], F.col(hash), slices, "_prev", attach=known)
    before = F.when(F.col("_prev").isNotNull(), F.col("_prev.v")).otherwise(F.col("_known"))
    outcome = (
        F.when(F.col("_prev").isNull() & F.col("norm_id").isNull(), "added")
        .when(~before.eqNullSafe(F.col(hash)), "updated")
        .otherwise("unchanged")
    )
    return items.withColumn("outcome", outcome).drop("_prev", "_known")


def merge_versions(norms: DataFrame, versions: DataFrame, batch: DataFrame, now: datetime | Column,
                   slices: Column | None = None, limits: dict[str, int] | None = None, highest: tuple[int, int] | None = None) -> Merge:
    """Merge a batch of items (url, seq, metadata, raw_text) into norms and versions.

    Fields stay whole unless `limits` (such as `fixed.FIELD_LIMITS`) are given; url and text_hash
    are never cut. Outcomes carry `cut_fields`, the number of fields cut in the item.

    Items of one url are taken in `seq` order. A changed hash replaces the
    metadata and adds a version; the validity fields are set when a norm is
    added and never by an update; an unchanged item touches nothing. The
    batch is staged once; items are judged by key, order and hash alone, and each of norms, versions and outcomes reads the columns it has. `norms` and `versions` may be those buckets of stored tables
    that the batch touches; `highest` then gives the greatest ids of norms and versions in all of them.
    """
    now = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    limits = {k: n for k, n in (limits or {}).items() if k not in UNCUT}
    cut = truncate_fields(batch, limits) if limits else batch.withColumn("cut_fields", F.lit(0))
    batch = stage(cut.withColumn("_row", F.monotonically_increasing_id()), "batch")
    judged = stage(merge_outcomes(norms, batch.select("_row", "url", "seq", "text_hash"), slices=slices).drop("text_hash"), "judged")
    items = batch.drop("outcome").join(judged.select("_row", "norm_id", "outcome"), "_row").drop("_row")
    changed = items.where(F.col("outcome") != "unchanged")
    valid = F.coalesce(F.col("is_valid").cast("int"), F.lit(1))
    per_url = changed.groupBy("url").agg(
        F.max_by(F.struct(*META), F.col("seq")).alias("m"),
        F.max(F.when(F.col("outcome") == "added", F.struct(valid.alias("is_valid"), F.col("status")))).alias("a"),
        F.max("norm_id").alias("norm_id"),
    )
    known = judged.where(F.col("outcome") != "unchanged").groupBy("url").agg(F.max("norm_id").alias("norm_id"))
    fresh = hash_rank(known.where(F.col("norm_id").isNull()).select("url"), F.sha2("url", 256), out="rank")
    base = F.lit(highest[0]) if highest else F.coalesce(norms.select(F.max("id")).scalar(), F.lit(0))
    new_ids = fresh.select("url", (base + F.col("rank")).alias("new_id"))
    changes = per_url.join(new_ids, "url", "left").select(
        "url", F.coalesce("norm_id", "new_id").alias("norm_id"), "m", "a"
    )

    old, new = norms.alias("o"), changes.alias("c")
    is_new = F.col("o.url").isNull()

    def pick(name: str) -> Column:
        o = F.col(f"o.{name}")
        if name in META:
            return F.col(f"c.m.{name}")
        added = {
            "id": F.col("c.norm_id"),
            "url": F.col("c.url"),
            "is_valid": F.col("c.a.is_valid"),
            "validation_message": F.when(F.col("c.a.is_valid") == 0, F.col("c.a.status")),
            "validation_date": now,
            "created_at": now,
        }
        if name in added:
            return F.when(is_new, added[name]).otherwise(o)
        if name == "last_hash":
            return F.col("c.m.text_hash")
        return now  # updated_at, last_updated_at

    changed_norms = new.join(old, F.col("o.url") == F.col("c.url"), "left").select(
        *[pick(f.name).cast(f.dataType).alias(f.name) for f in schemas.NORMS.fields]
    )
    merged = norms.join(changes.select("url"), "url", "left_anti").select(*schemas.NORMS.names).unionByName(changed_norms)

    snap = F.to_json(F.struct("url", *META))
    added_versions = salted_join(changed.drop("norm_id"), changes.select("url", "norm_id"), "url", "seq")
    vbase = F.lit(highest[1]) if highest else F.coalesce(versions.select(F.max("id")).scalar(), F.lit(0))
    digest = F.sha2(F.concat_ws("|", "url", F.col("seq").cast("string")), 256)
    numbered = hash_rank(added_versions, digest, out="rank")
    appended = numbered.select(
        (vbase + F.col("rank")).alias("id"), "norm_id", now.alias("version_date"), "text_hash", "raw_text", snap.alias("metadata_json")
    )
    outcomes = salted_join(items, new_ids, "url", "seq", "left").withColumn("norm_id", F.coalesce("norm_id", "new_id")).drop("new_id")
    new_versions = schemas.conform(appended, schemas.VERSIONS)
    return Merge(merged, versions.unionByName(new_versions), outcomes, changed_norms, new_versions)


def replace_children(children: DataFrame, new: DataFrame, changed: DataFrame, key: str = "norm_id",
                     keep_when_empty: bool = True, again: DataFrame | None = None) -> DataFrame:
    """Children of changed parents replaced by the new ones.

    With `keep_when_empty` a changed parent that yielded no new child keeps its old ones. Whether it did needs asking of parents
    with old children only: `again` may give the new children of those, which spares taking all apart a second time.
    """
    gone = changed.select(key).distinct()
    if keep_when_empty:
        gone = gone.join((new if again is None else again).select(key).distinct(), key, "left_semi")
    return children.join(gone, key, "left_anti").unionByName(new)


def outcome_totals(outcomes: DataFrame, outcome: str = "outcome") -> DataFrame:
    return outcomes.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


# --- Validation ---------------------------------------------------------------

def validity_changes(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rows with `change`: to_valid (0 to 1), to_invalid (1 to 0) or none."""
    change = (
        F.when((F.col(old) == 0) & (F.col(new) == 1), "to_valid")
        .when((F.col(old) == 1) & (F.col(new) == 0), "to_invalid")
        .otherwise("none")
    )
    return df.withColumn("change", change)


def validity_history(df: DataFrame, key: list[str], seq: list[str], valid: str, slices: Column | None = None) -> DataFrame:
    """Each row against the one before it under the same key."""
    slices = order_slices(df, seq[0]) if slices is None else slices
    prev = lag_sliced(df, key, seq, F.col(valid), slices, "_prev").withColumn("_old", F.col("_prev.v"))
    return validity_changes(prev, "_old", valid).drop("_prev", "_old")


def validation_totals(df: DataFrame, old: str, new: str, error: str | None = None) -> DataFrame:
    """Checked, valid, invalid, errors and changed rows. Rows in error are not counted as checked."""
    bad = F.col(error).isNotNull() if error else F.lit(False)
    ok = ~bad
    return df.agg(
        F.count_if(ok).alias("checked"),
        F.count_if(ok & (F.col(new) == 1)).alias("valid"),
        F.count_if(ok & (F.col(new) == 0)).alias("invalid"),
        F.count_if(bad).alias("errors"),
        F.count_if(ok & (((F.col(old) == 0) & (F.col(new) == 1)) | ((F.col(old) == 1) & (F.col(new) == 0)))).alias("changed"),
    )


# --- Sampling -----------------------------------------------------------------

def quota_sample(df: DataFrame, id: str, group: str, date: str, plan: list[tuple[str, str]], per_entry: int, target: int) -> DataFrame:
    """Sample by a plan of (group, "1" newest first | "2" oldest first): at most `per_entry` rows each,
    an id taken by an earlier entry is skipped, `target` rows in all.

    One scan serves all entries. Entries before the i-th take at most i * per_entry ids, so its first (i + 1) * per_entry
    ids are all it can need; only those leave the tasks. Settling them in turn is done in one task, on
    at most per_entry * n * (n + 1) / 2 rows for a plan of n entries, however many rows `df` has.
    """
    n, id_type = len(plan), df.schema[id].dataType.simpleString()
    entries = F.array(*[F.struct(F.lit(i).alias("entry"), F.lit(name).alias("of"), F.lit(how).alias("how")) for i, (name, how) in enumerate(plan)])
    rows = df.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(group).alias("of"), F.col(date).alias("day"))
    met = rows.select("id", "day", F.explode(F.filter(entries, lambda e: e["of"] == F.col("of"))).alias("e"))
    once = met.groupBy("id", "e.entry", "e.how").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    oldest, newest = F.when(F.col("how") == "2", F.col("first")), F.when(F.col("how") != "2", F.col("last"))
    place = F.row_number().over(Window.partitionBy("entry").orderBy(oldest.asc_nulls_last(), newest.desc_nulls_last(), "id"))
    able = once.withColumn("place", place).where((F.col("place") <= n * per_entry) & (F.col("place") <= (F.col("entry") + 1) * per_entry))

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for entry, part in frame.sort_values(["entry", "place"]).groupby("entry"):
            free = [i for i in part["id"] if i not in taken][:per_entry]
            taken.update(free)
            out += [(i, entry, rank) for rank, i in enumerate(free, 1)]
        return pd.DataFrame(out, columns=["id", "entry", "rank"])

    settled = able.select("entry", "place", "id").groupBy().applyInPandas(settle, f"id {id_type}, entry int, rank int")
    return settled.select(F.col("id").alias(id), "entry", "rank").orderBy("entry", "rank").limit(target)
