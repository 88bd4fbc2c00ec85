"""Near-duplicates by the Jaccard similarity of word shingles: candidates by SimHash and by MinHash bands, each checked on the whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import text_key
from lexmill.llm.components import connected_components
from lexmill.llm.simhash import keep_smallest, near_links, shingle_hashes, simhash
from lexmill.session import stage

#: A pair of similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS: 0.99997 at 0.8.
BANDS, ROWS = 26, 5
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
#: Shingles that a minimum is taken over at once.
_STEP = 4096
#: A pair is checked if so many minima fewer than the similarity leads one to expect are equal: 4.2 standard deviations at 0.8, passed by with a chance of 2e-5.
_MARGIN = 19
#: Sets of a bucket that are held at once; a larger bucket is cut into blocks.
BLOCK = 512
#: Larger sets do not travel with the rows of a bucket; pairs with such a set are checked in a join of their own.
LONG = 1 << 14


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, words))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The MinHash signature of a set: the low half of one minimum per row of each band; nothing for the empty set."""
    if not len(shingles):
        return np.empty(0, np.uint32)
    lowest = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _STEP):
        np.minimum(lowest, (_FACTORS[:, None] * shingles[None, i:i + _STEP]).min(axis=1), out=lowest)
    return lowest.astype(np.uint32)


def keys_of(minima: np.ndarray) -> list[int]:
    """One key per band of a signature."""
    return [_signed(row.tobytes(), band) for band, row in enumerate(minima.reshape(-1, ROWS))]


def band_keys(shingles: np.ndarray) -> list[int]:
    """One key per band of the MinHash signature of a set; none for the empty set."""
    return keys_of(signature(shingles))


def _signed(data: bytes, seed: int) -> int:
    value = xxhash.xxh64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def node_of(shingles: np.ndarray) -> int:
    """Hash of a whole set: texts with equal sets are one node."""
    return _signed(shingles.tobytes(), 0) if len(shingles) else 0


def sketches(df: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """id, text_key, node, n (shingles of the set), minima (its signature), fp (SimHash) and keys (MinHash bands, then the SimHash itself) for every row; null counts as empty."""
    id_type = df.schema[id].dataType

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, minima, fps, keys = [], [], [], [], []
            for value in batch.column(1).cast(pa.large_binary()):
                hashes = shingle_hashes(value.as_py() or b"", words)
                shingles, fp = np.unique(hashes), simhash(hashes)
                lowest = signature(shingles)
                nodes.append(node_of(shingles))
                sizes.append(len(shingles))
                minima.append(lowest.tobytes())
                fps.append(fp)
                keys.append([*keys_of(lowest), _signed(fp.to_bytes(8, "little", signed=True), BANDS)])
            columns = [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(minima, pa.binary()),
                       pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "node", "n", "minima", "fp", "keys"])

    slim = df.select(F.col(id).alias("id"), F.col(text).alias("text"), text_key(id, text).alias("text_key"))
    return slim.mapInArrow(sketch, f"id {id_type.simpleString()}, text_key long, node long, n long, minima binary, fp long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """node, shingles (sorted hashes, 8 bytes each) of the texts whose text_key is `wanted`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(value.as_py() or b"", words) for value in batch.column(0).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, found), pa.int64()), pa.array((s.tobytes() for s in found), pa.binary())], ["node", "shingles"])

    keyed = docs.select(text_key(id, text).alias("text_key"), F.col(text).alias("text"))
    texts = keyed.join(wanted.select("text_key").hint("merge"), "text_key", "left_semi").select("text")
    return texts.mapInArrow(read, "node long, shingles binary").dropDuplicates(["node"])


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many shingles two sets share."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    shared = _shared(x, y)
    every = len(x) + len(y) - shared
    return every > 0 and shared / every >= similarity


def _checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of `similarity` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_alike(*(np.frombuffer(s.as_buffer() or b"", np.uint64) for s in pair), similarity) for pair in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    # The side of b comes first: it is the smaller node of a pair, a, that can be hot.
    x, y = (sets.select(F.col("node").alias(n), F.col("shingles").alias(c)).hint("merge") for n, c in (("a", "x"), ("b", "y")))
    met = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y")
    return met.mapInArrow(check, "a long, b long")


class _Bucket:
    """Links between the sets of one block of a bucket, found as its rows come; sets joined by a chain of links are not compared again."""

    def __init__(self, minima: bytes, key: int, similarity: float):
        keys = keys_of(np.frombuffer(minima, np.uint32))
        #: A pair is looked at in the first band it shares; the bucket of a fingerprint comes after all bands.
        self.band = keys.index(key) if key in keys else BANDS
        self.similarity = similarity
        self.least = int(similarity * BANDS * ROWS) - _MARGIN
        self.entries: dict[str, np.ndarray] | None = None
        self.joined: dict[int, int] = {}

    def _root(self, component: int) -> int:
        while (above := self.joined.get(component, component)) != component:
            component = above
        return component

    def add(self, rows: pd.DataFrame) -> Iterator[tuple[int, int, bool]]:
        """Compares `rows` with the entries so far and takes up those that are entries, some at a time."""
        for i in range(0, len(rows), 256):
            part = rows.iloc[i:i + 256]
            new = {c: part[c].to_numpy() for c in ("node", "component", "n", "is_entry", "shingles")}
            new["minima"] = np.stack([np.frombuffer(m, np.uint32) for m in part["minima"]])
            before = 0 if self.entries is None else len(self.entries["node"])
            own = {c: v[new["is_entry"]] for c, v in new.items()}
            self.entries = own if self.entries is None else {c: np.concatenate([v, own[c]]) for c, v in self.entries.items()}
            # An entry meets those before it, any other row all entries.
            place = np.where(new["is_entry"], before + np.cumsum(new["is_entry"]) - 1, len(self.entries["node"]))
            if len(self.entries["node"]):
                yield from self._compare(new, place)

    def _compare(self, rows: dict[str, np.ndarray], place: np.ndarray) -> Iterator[tuple[int, int, bool]]:
        to = self.entries
        step = max(1, (1 << 22) // (len(to["node"]) * BANDS * ROWS))
        found = []
        for i in range(0, len(place), step):
            at = slice(i, i + step)
            equal = rows["minima"][at, None] == to["minima"][None]
            count = np.count_nonzero(equal, axis=-1)
            small, large = np.minimum(rows["n"][at, None], to["n"]), np.maximum(rows["n"][at, None], to["n"])
            able = (count >= self.least) & (small >= self.similarity * large) & (rows["component"][at, None] != to["component"])
            able &= np.arange(len(to["node"])) < place[at, None]
            x, y = np.nonzero(able)
            first = ~equal.reshape(*count.shape, BANDS, ROWS)[x, y, :self.band].all(axis=-1).any(axis=-1)
            found.append((x[first] + i, y[first], count[x[first], y[first]]))
        x, y, count = (np.concatenate(c) for c in zip(*found))
        for j in np.argsort(-count, kind="stable"):
            a, b = x[j], y[j]
            root_a, root_b = self._root(rows["component"][a]), self._root(to["component"][b])
            if root_a == root_b:
                continue
            sets = rows["shingles"][a], to["shingles"][b]
            if sets[0] is None or sets[1] is None:
                yield rows["node"][a], to["node"][b], False
            elif _alike(*(np.frombuffer(s, np.uint64) for s in sets), self.similarity):
                self.joined[max(root_a, root_b)] = min(root_a, root_b)
                yield rows["node"][a], to["node"][b], True


def _linked(similarity: float):
    """Function for mapInPandas over rows sorted by key, block and entries first: a, b, sure (false for a pair still to be checked)."""

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, bucket = None, None
        for frame in frames:
            out = []
            for place, rows in frame.groupby(["key", "block"], sort=False):
                if place != at:
                    at, bucket = place, _Bucket(rows["minima"].iloc[0], place[0], similarity)
                out += bucket.add(rows)
            yield pd.DataFrame(out, columns=["a", "b", "sure"])

    return link


def links_within(rows: DataFrame, sets: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """a, b: links that connect all pairs of a bucket with `similarity` or more, for rows (key, node, component, n, minima).

    Each set comes to a block of its bucket once. There pairs are told apart by their signatures and sizes,
    and those that may be similar are checked on the whole sets, the likeliest first, unless links found before
    already join them. Pairs are never rows, but for those with a set of over `LONG` shingles. A bucket of
    more than `block` sets is cut; each block is met by the rows of the blocks before it.
    """
    large = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    shingles = F.when(F.octet_length("shingles") <= 8 * LONG, F.col("shingles")).alias("shingles")
    met = rows.join(large, "key", "left").join(sets.select("node", shingles).hint("merge"), "node").withColumn("own", own)
    dealt = met.withColumn("block", F.explode(F.sequence(F.col("own"), blocks - 1))).select(
        "key", "block", (F.col("block") == F.col("own")).alias("is_entry"), "node", "component", "n", "minima", "shingles")
    ordered = dealt.repartition("key", "block").sortWithinPartitions("key", "block", F.desc("is_entry"), "node")
    found = stage(ordered.mapInPandas(_linked(similarity), "a long, b long, sure boolean"), "similar")
    unsure = stage(found.where(~F.col("sure")).select("a", "b").distinct(), "pairs")
    return found.where("sure").select("a", "b").union(stage(_checked(unsure, sets, similarity), "similar"))


def similar_links(docs: DataFrame, classes: DataFrame, id: str, text: str, similarity: float, words: int) -> DataFrame:
    """a, b: links between nodes (node, n, minima, fp, keys, text_key) that connect all pairs of a bucket with `similarity` or more.

    A bucket holds the nodes that share a band or a fingerprint; fingerprints within four bits are
    candidates too. First each node is checked against the smallest node of its buckets, so a group of
    near-duplicates costs as many checks as it has nodes. Where a bucket still holds more than one
    component, its rows meet in `links_within`.
    """
    rows = classes.select("node", F.explode("keys").alias("key"))
    hubs = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = stage(rows.join(hubs.hint("merge"), "key"), "members")
    prints = stage(classes.groupBy("fp").agg(F.min("node").alias("rep")), "prints")
    near = near_links(prints).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stage(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).union(near).distinct(), "pairs")
    wanted = members.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    sets = stage(_sets(docs, classes.select("node", "text_key").join(wanted.hint("merge"), "node", "left_semi"), id, text, words), "shingle-sets")
    links = stage(_checked(pairs, sets, similarity), "similar")

    joined = connected_components(links, "a", "b")
    placed = members.join(joined.hint("merge"), "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rest = stage(placed.join(mixed.hint("merge"), "key", "left_semi"), "mixed")
    if rest.isEmpty():
        return links
    signed = rest.join(classes.select("node", "n", "minima").hint("merge"), "node")
    return links.union(links_within(signed, sets, similarity))


def similar_components(df: DataFrame, id: str, text: str, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """id, text_key, component_id for every row of `df`; rows link if the sets of their shingles have a Jaccard similarity of `similarity` or more.

    Equal sets form one class and are represented by their smallest id; texts without words have the
    empty set. Rows that share an id share its class. A row with a null id gets the component of its
    set, which is null if no row with that set has an id.
    """
    found = stage(sketches(df, id, text, words), "sketches")
    classes = stage(found.groupBy("node").agg(F.min("id").alias("rep"), F.min("text_key").alias("text_key"), *(F.first(c).alias(c) for c in ("n", "minima", "fp", "keys"))), "classes")
    reps = classes.select("node", "rep")
    links = similar_links(df, classes.where(F.col("rep").isNotNull()), id, text, similarity, words)
    for end in ("a", "b"):
        links = links.join(reps.select(F.col("node").alias(end), F.col("rep").alias(f"rep_{end}")).hint("merge"), end)
    components = connected_components(links, "rep_a", "rep_b")
    placed = reps.join(components.hint("merge"), reps["rep"] == components["node"], "left").select(
        reps["node"], F.coalesce("component", "rep").alias("component_id"))
    return found.join(placed.hint("merge"), "node").select(F.col("id").alias(id), "text_key", "component_id")


def keep_one_of_similar(docs: DataFrame, id: str, text: str, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """`docs` with one document of each component, that of the smallest id, and all its columns; see `keep_smallest`."""
    return keep_smallest(docs, stage(similar_components(docs, id, text, similarity, words), "components"), id, text)
