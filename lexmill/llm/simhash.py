"""Near-duplicates by SimHash: multi-index hashing over segments of the fingerprint."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import query, table, text_key, without
from lexmill.llm.components import connected_components
from lexmill.session import stage

BITS = 64
#: Rows of one index entry that a task compares others with at once; a larger entry is cut into blocks.
BLOCK = 16_384
_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """Hash of every shingle of a UTF-8 text, in its order; a text shorter than a shingle is one, and a text without words has none."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(tokens) - words + 1)]
    ends = ends[words - 1:] if len(tokens) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts.tolist(), ends.tolist())], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have, as a signed number; 0 without hashes."""
    if not len(hashes):
        return 0
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(by_byte[:, j], minlength=256) @ _BIT_OF_BYTE for j in range(8)])
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """SimHash of the shingles of a UTF-8 text; 0 without words. A bit is set if more than half of the hashes have it."""
    return simhash(shingle_hashes(text, words, seed))


def fingerprints(df: DataFrame, id: str, text: str, words: int = 4, seed: int = 42) -> DataFrame:
    """id, text_key, fp (long) for every row, from the whole text; null counts as empty."""
    id_type = df.schema[id].dataType

    def hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            fps = pa.array((fingerprint(t.as_py() or b"", words, seed) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), fps], ["id", "text_key", "fp"])

    slim = df.select(F.col(id).alias("id"), F.col(text).alias("text"), text_key(id, text).alias("text_key"))
    return slim.mapInArrow(hash_batches, f"id {id_type.simpleString()}, text_key long, fp long")


def _segments(m: int) -> list[tuple[int, int]]:
    """(offset, width) of m nearly equal segments."""
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _index_rows(classes: DataFrame, m: int, distance: int) -> DataFrame:
    """Index entries and probes: key (segment and value), is_entry, fp, rep.

    Of two fingerprints within `distance`, some segment differs in at most
    distance // m bits. Each fingerprint is an entry under the value of each of
    its segments, and probes all values in that Hamming ball that are smaller
    than its own: of two that differ, only the larger meets the other.
    """
    masks = [
        (s, off, (1 << width) - 1, sum(1 << i for i in flips))
        for s, (off, width) in enumerate(_segments(m))
        for r in range(distance // m + 1)
        for flips in combinations(range(width), r)
    ]
    wanted = F.array(*[F.struct(*[F.lit(x).cast("long").alias(n) for n, x in zip(("seg", "off", "ones", "mask"), row)]) for row in masks])
    value = F.expr("shiftrightunsigned(fp, cast(p.off as int)) & p.ones")
    return (
        classes.select("fp", "rep", F.explode(wanted).alias("p"))
        .select("fp", "rep", (F.col("p.mask") == 0).alias("is_entry"), value.alias("v"), F.col("p.seg").alias("seg"), F.col("p.mask").alias("mask"))
        .withColumn("near", F.col("v").bitwiseXOR(F.col("mask")))
        .where(F.col("near") <= F.col("v"))
        .select((F.shiftleft("seg", 40) + F.col("near")).alias("key"), "is_entry", "fp", "rep")
    )


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Cuts the entries of a large key into blocks; probes, and entries of other blocks as probes, go to each.

    The table of large keys has at most (entries / block) rows.
    """
    large = rows.where("is_entry").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    large = stage(large.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "large-keys")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    met = F.sequence(F.when(F.col("is_entry"), own).otherwise(0), blocks - 1)
    return rows.join(large, "key", "left").withColumn("own", own).withColumn("block", F.explode(met)).select(
        "key", "block", (F.col("is_entry") & (F.col("own") == F.col("block"))).alias("is_entry"), "fp", "rep")


def _spanning(rows_fp: np.ndarray, entry_fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (row, entry) that connect what is within the distance, one per row and one per merge of entries.

    The rows stand for probes and for the entries themselves.
    """
    label = np.arange(len(entry_fp))
    step = max(1, (1 << 22) // max(1, len(entry_fp)))
    for i in range(0, len(rows_fp), step):
        near = np.bitwise_count(rows_fp[i:i + step, None] ^ entry_fp[None]) <= distance
        hit = np.flatnonzero(near.any(axis=1))
        near = near[hit]
        first = near.argmax(axis=1)
        yield hit + i, first
        lowest = np.where(near, label, len(label)).min(axis=1, initial=len(label))
        for j in np.flatnonzero(lowest != np.where(near, label, -1).max(axis=1, initial=-1)):
            merged = np.unique(label[near[j]])
            if len(merged) > 1:
                ends = np.array([np.flatnonzero(near[j] & (label == o))[0] for o in merged], np.int64)
                yield np.full(len(ends), hit[j] + i), ends
                label[np.isin(label, merged)] = merged[0]


def _link_batches(distance: int, small: int = 4096):
    """Function for mapInPandas over rows sorted by key, block and entries first: a, b (reps) of verified links."""

    def within(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Links inside whole groups of `frame`."""
        key, block = frame["key"].to_numpy(), frame["block"].to_numpy()
        fp, rep, entry = frame["fp"].to_numpy().view(np.uint64), frame["rep"].to_numpy(), frame["is_entry"].to_numpy()
        new = np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
        start = np.flatnonzero(new)
        size = np.diff(np.r_[start, len(key)])
        entries = np.add.reduceat(entry, start, dtype=np.int64)
        a, b = [], []
        for s, n, e in zip(start, size, entries):
            if e and e * n > small:
                for i, j in _spanning(fp[s:s + n], fp[s:s + e], distance):
                    a.append(rep[s + i])
                    b.append(rep[s + j])
        group = np.cumsum(new) - 1
        few = (entries > 0) & (size > 1) & (entries * size <= small)
        row = np.flatnonzero(few[group])
        # A probe meets all entries of its group, an entry those before it.
        meets = np.where(entry[row], row - start[group[row]], entries[group[row]])
        for part in np.array_split(np.arange(len(row)), max(1, int(meets.sum()) >> 22)):
            left = np.repeat(row[part], meets[part])
            right = np.arange(len(left)) - np.repeat(np.cumsum(meets[part]) - meets[part], meets[part]) + np.repeat(start[group[row[part]]], meets[part])
            near = np.bitwise_count(fp[left] ^ fp[right]) <= distance
            a.append(rep[left[near]])
            b.append(rep[right[near]])
        links = pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})
        yield links[links["a"] != links["b"]].drop_duplicates()

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if not len(frame):
                continue
            key, block = frame["key"].to_numpy(), frame["block"].to_numpy()
            last = int(np.flatnonzero((key == key[-1]) & (block == block[-1]))[0])
            if last:
                yield from within(frame.iloc[:last])
            held = frame.iloc[last:]
            if len(held) > 8 * BLOCK:  # a hot group: its entries stay, the probes seen so far are done with
                yield from within(held)
                held = held[held["is_entry"]]
        if held is not None and len(held):
            yield from within(held)

    return link


def near_links(classes: DataFrame, distance: int = 4, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """a, b: links between distinct fingerprints (fp, rep) that connect all within `distance` bits of each other.

    Dense groups yield a spanning set of their links, not all pairs. Any number of
    segments gives the same components; by default three (21 or 22 bits, balls of
    one flip) up to 2**24 fingerprints and then two (32 bits, two flips), so that an
    entry holds few fingerprints that have nothing in common.
    """
    m = segments or (3 if classes.count() <= 1 << 24 else 2)
    rows = _in_blocks(_index_rows(classes, m, distance), block)
    sorted_rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", F.desc("is_entry"))
    return sorted_rows.mapInPandas(_link_batches(distance), "a long, b long")


def simhash_components(df: DataFrame, id: str, text: str, distance: int = 4, words: int = 4) -> DataFrame:
    """id, text_key, fp, component_id for every row of `df`.

    Equal fingerprints form one class and are represented by their smallest id.
    A text that is null, empty or blank has fingerprint 0 and links like any
    other. Rows that share an id share its class. A row with a null id gets the
    component of its fingerprint, which is null if no row of that class has an
    id. No rows give no rows; other columns are not looked at.
    """
    fps = stage(fingerprints(df, id, text, words), "fingerprints")
    classes = stage(fps.groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    links = near_links(classes.where(F.col("rep").isNotNull()), distance)
    components = connected_components(links, "a", "b")
    placed = classes.join(components, classes["rep"] == components["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(placed, "fp").select(F.col("id").alias(id), "text_key", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, id: str, text: str, distance: int = 4, words: int = 4) -> DataFrame:
    """`docs` with one document of each component, that of the smallest id, and all its columns.

    Of rows that share that id one stays. Rows without id stay only where no row of their fingerprint has one.
    """
    return keep_smallest(docs, stage(simhash_components(docs, id, text, distance, words), "components"), id, text)


def keep_smallest(docs: DataFrame, found: DataFrame, id: str, text: str) -> DataFrame:
    """`docs` without the rows that `found` (id, text_key, component_id) places in the component of another id; of rows that share an id one stays."""
    own = F.col(id) == F.col("component_id")
    gone = found.where(F.col("component_id").isNotNull() & ~F.coalesce(own, F.lit(False))).select(F.col(id).alias("id"), "text_key")
    kept = without(docs, stage(gone.distinct(), "duplicates"), id, text)
    repeated = stage(found.where(own).groupBy(id).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id), "repeated-ids")
    if repeated.isEmpty():
        return kept
    rest, again = (kept.join(repeated, id, how).select(*docs.columns) for how in ("left_anti", "left_semi"))
    return rest.union(again.dropDuplicates([id]))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


@query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark, sf):
    """Fingerprint and component of every document."""
    found = simhash_components(table(spark, sf, "documents"), "doc_id", "text")
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")
