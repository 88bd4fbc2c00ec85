"""Merkle manifest of a data set: a postorder append log of nodes, its proofs, and what tampering does to them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import lower_ascii, number_rows, query, table
from lexmill.operators.skew import salted_join
from lexmill.session import stage

#: Children of a node, and the levels that one builder closes over an aligned block of FAN ** LEVELS units.
FAN, LEVELS = 16, 3
BLOCK = FAN ** LEVELS


def position(last_leaf: int, level: int) -> int:
    """Place in the postorder log of the node of `level` whose subtree ends with leaf number `last_leaf`.

    Before that leaf stand the leaves before it and, of each level k, the last_leaf // FAN**k nodes
    that were full by then; between it and its ancestor stand the ancestors below that one.
    """
    place = last_leaf + level
    while last_leaf := last_leaf // FAN:
        place += last_leaf
    return place


def node_position(level: int, index: int, n_leaves: int) -> int:
    """Place of node number `index` of a level in the log of a tree of `n_leaves`."""
    return position(min(n_leaves, (index + 1) * FAN ** level) - 1, level)


def height(n_leaves: int) -> int:
    """Levels above the leaves; a lone leaf is its own root."""
    level = 0
    while n_leaves > 1:
        n_leaves, level = -(-n_leaves // FAN), level + 1
    return level


def node_hash(children: list[bytes]) -> bytes:
    """SHA-256 over the children's digests as lowercase hex text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 (binary) over each field as `-` if null, else its UTF-8 byte count, a colon and its text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Manifest(NamedTuple):
    """Leaves in place (tree, at, n, leaf and more), the logs of their trees by round, the trees (tree, n, subroot), and the log of the tree above them."""

    placed: DataFrame
    logs: list[DataFrame]
    trees: DataFrame
    top_logs: list[DataFrame]


_LOG = "tree long, n long, level int, index long, position long, digest binary"
_LOG_NAMES = ["tree", "n", "level", "index", "position", "digest"]
_LOG_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def _append(base: int):
    """Function for mapInArrow over units (tree, n, index, digest) sorted by tree and index, whole blocks at a time.

    Each unit is appended to the open run of its level; a full run, or the last of a tree, closes into a node,
    which is appended to the run above. Nodes are passed on as they are completed.
    """

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[list[bytes]] = [[] for _ in range(LEVELS)]
        for batch in batches:
            out: list[tuple] = []
            for tree, n, index, digest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                top, last = height(n), min(n, (index + 1) * FAN ** base) - 1
                if not base:
                    out.append((tree, n, 0, index, position(last, 0), digest))
                for step in range(min(LEVELS, top - base)):
                    runs[step].append(digest)
                    if (index + 1) % FAN and last != n - 1:
                        break
                    digest, index = node_hash(runs[step]), index // FAN
                    runs[step].clear()
                    out.append((tree, n, base + step + 1, index, position(last, base + step + 1), digest))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _LOG_TYPES)] if out else [pa.array([], t) for t in _LOG_TYPES], _LOG_NAMES)

    return close


def append_log(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The log of every tree, one frame per round, from leaves (tree, n, index, digest); `most` is the largest n.

    Round r closes levels 3r-2 to 3r. A builder owns aligned blocks of 4,096 units, so its nodes are whole
    subtrees and their places in the log follow from their sizes; a tree of any size is built by
    many tasks, and no task holds more than three open runs. Each round is written under the shared folder.
    """
    logs, units = [], leaves
    for r in range(max(1, -(-height(most) // LEVELS))):
        base = r * LEVELS
        block = (F.col("index") - F.pmod("index", F.lit(BLOCK)))
        dealt = units.select("tree", "n", "index", "digest").repartition(F.col("tree"), block).sortWithinPartitions("tree", "index")
        logs.append(stage(dealt.mapInArrow(_append(base), _LOG), f"merkle-log-{r + 1}"))
        units = logs[-1].where((F.col("level") == base + LEVELS) & (F.col("n") > FAN ** (base + LEVELS)))
    return logs


def _roots(logs: list[DataFrame]) -> DataFrame:
    """tree, n, digest of the last node in the log of each tree."""
    ends = [log.where((F.col("index") == 0) & (F.col("level") <= LEVELS * (r + 1))) for r, log in enumerate(logs)]
    wide = lambda level: F.pow(F.lit(float(FAN)), level)
    tops = [e.where((wide(F.col("level")) >= F.col("n")) & ((F.col("level") == 0) | (wide(F.col("level") - 1) < F.col("n")))) for e in ends]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out.select("tree", "n", "digest")


class _Segment:
    """The log of one block in memory: digests by their place, and the run of children of a node by closed-form places."""

    def __init__(self):
        self.at: dict[int, bytes] = {}
        self.runs: dict[tuple[int, int], bytes] = {}

    def run(self, level: int, parent: int, n: int) -> bytes:
        """The digests of the children, which stand at `level`, of node `parent` above them."""
        if (known := self.runs.get((level, parent))) is None:
            first, end = parent * FAN, min(parent * FAN + FAN, -(-n // FAN ** level))
            known = self.runs[level, parent] = b"".join(self.at[node_position(level, i, n)] for i in range(first, end))
        return known

    def proof(self, base: int, index: int, n: int) -> list[bytes]:
        """Runs from the unit's own level up to the head of the block."""
        runs = []
        for level in range(base, min(base + LEVELS, height(n))):
            index //= FAN
            runs.append(self.run(level, index, n))
        return runs


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(head, segment, unit) for each unit of rows sorted by tree, block and kind: head of the block, its log, its units."""
    key = head = segment = None
    for batch in batches:
        for row in batch.to_pylist():
            if key != (row["tree"], row["block"]):
                key, segment = (row["tree"], row["block"]), _Segment()
            if row["kind"] == 0:
                head = row
            elif row["kind"] == 1:
                segment.at[row["position"]] = row["digest"]
            else:
                yield head, segment, row


def _met(units: DataFrame, logs: list[DataFrame], heads: DataFrame, r: int) -> DataFrame:
    """Heads, log and units of round r, together by block: what `_blocks` reads."""
    base = LEVELS * r
    block = F.floor(F.col("index") / F.pow(F.lit(float(FAN)), F.lit(base + LEVELS) - F.col("level"))).cast("long")  # powers of two are exact
    entries = logs[r] if r == 0 else logs[r].unionByName(logs[r - 1].where((F.col("level") == base) & (F.col("n") > FAN ** base)))
    kinds = [
        heads.withColumn("kind", F.lit(0)),
        entries.select("tree", block.alias("block"), F.lit(1).alias("kind"), "position", "digest"),
        units.withColumn("kind", F.lit(2)).withColumn("block", F.floor(F.col("index") / BLOCK).cast("long")),
    ]
    rows = kinds[0]
    for more in kinds[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind")


def _heads(logs: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Heads of the blocks of leaves: tree, block, runs (those above the block, from below up) and the columns of `tops` (tree, n and more), from the last round down."""
    more = [c for c in tops.columns if c not in ("tree", "n")]
    types = dict(tops.dtypes)
    schema = "tree long, n long, block long, runs array<binary>" + "".join(f", {c} {types[c]}" for c in more)
    heads = None
    for r in reversed(range(len(logs))):
        low, high = (FAN ** (LEVELS * r) if r else 0), FAN ** (LEVELS * (r + 1))
        ends = tops.where((F.col("n") > low) & (F.col("n") <= high)).withColumn("block", F.lit(0).cast("long")).withColumn("runs", F.expr("cast(array() as array<binary>)"))
        heads = ends if heads is None else heads.unionByName(ends)
        if r:
            def read(batches: Iterator[pa.RecordBatch], base: int = LEVELS * r) -> Iterator[pa.RecordBatch]:
                for head, segment, unit in _blocks(batches):
                    runs = segment.proof(base, unit["index"], head["n"]) + head["runs"]
                    yield pa.RecordBatch.from_pylist([{"tree": unit["tree"], "n": head["n"], "block": unit["index"], "runs": runs} | {c: head[c] for c in more}], wanted)

            wanted = _arrow(tops, more)
            units = logs[r - 1].where((F.col("level") == LEVELS * r) & (F.col("n") > low)).select("tree", "index")
            heads = stage(_met(units, logs, heads, r).mapInArrow(read, schema), "merkle-heads")
    return heads


def _arrow(tops: DataFrame, more: list[str]) -> pa.Schema:
    kinds = {"binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "bigint": pa.int64()}
    fixed = [("tree", pa.int64()), ("n", pa.int64()), ("block", pa.int64()), ("runs", pa.list_(pa.binary()))]
    return pa.schema(fixed + [(c, kinds[dict(tops.dtypes)[c]]) for c in more])


def build_manifest(df: DataFrame, id: str, source: str, leaf: Column, **more: Column) -> Manifest:
    """Trees of the rows of each source, in the order of id, and a tree of their roots in the order of source.

    `leaf` is a binary digest of a row, as of `leaf_hash`; only it, id, source and the columns `more` move. Null
    sources are a source and come first, as do null ids; rows equal in id and leaf are interchangeable. A hot source
    is numbered by ranges and built by many builders. No rows give no trees.
    """
    known = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    slim = df.select(F.col(id).alias("id"), F.col(source).alias("source"), known.alias("key"), leaf.alias("leaf"), *[c.alias(n) for n, c in more.items()])
    numbered, _ = number_rows(slim, ["key", "id", "leaf"], "row")
    sizes = stage(numbered.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("start")), "sources")
    ordered, n_trees = number_rows(sizes, ["key"], "tree")
    placed = salted_join(numbered, ordered, "key", "row").withColumn("at", F.col("row") - F.col("start")).drop("key", "row", "start")
    placed = stage(placed, "placed")
    most = ordered.agg(F.max("n")).first()[0] or 0
    logs = append_log(placed.select("tree", "n", F.col("at").alias("index"), F.col("leaf").alias("digest")), most)
    trees = stage(_roots(logs).withColumnRenamed("digest", "subroot"), "trees")
    tops = trees.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("index"), F.col("subroot").alias("digest"))
    return Manifest(placed, logs, trees, append_log(tops, n_trees))


def _tops(manifest: Manifest) -> DataFrame:
    """tree, n, subroot, root, above (runs from the subroot up to the root) of every tree."""
    above = manifest.top_logs
    ends = _roots(above).withColumnRenamed("digest", "root")
    heads = _heads(above, ends)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, segment, unit in _blocks(batches):
            yield pa.RecordBatch.from_pylist([{"tree": unit["index"], "root": head["root"], "above": segment.proof(0, unit["index"], head["n"]) + head["runs"]}],
                                             pa.schema([("tree", pa.int64()), ("root", pa.binary()), ("above", pa.list_(pa.binary()))]))

    units = manifest.trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"))
    proofs = _met(units, above, heads, 0).mapInArrow(read, "tree long, root binary, above array<binary>")
    return stage(manifest.trees.join(proofs, "tree"), "tops")


_SIZE = 64


def _siblings(own: int, run: str) -> tuple[str, str]:
    """What stands left and right of the own digest in a run in hex."""
    cut = _SIZE * (own % FAN)
    return run[:cut], run[cut + _SIZE:]


def _with_proofs(manifest: Manifest, wanted: DataFrame | None, columns: list[str], make, schema: str, types: list[pa.DataType]) -> DataFrame:
    """`make(leaf row, left and right siblings by level, subroot, root)` for every leaf, or those of `wanted` (tree, at), each from the log of its own block."""
    tops = _tops(manifest)
    placed = manifest.placed if wanted is None else manifest.placed.join(wanted.select("tree", "at"), ["tree", "at"], "left_semi")
    units = placed.select("tree", F.col("at").alias("index"), *columns)
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        hexes: dict[bytes, str] = {}
        for head, segment, unit in _blocks(batches):
            levels, index = [], unit["index"]
            for runs, index in ((segment.proof(0, index, head["n"]) + head["runs"], index), (head["above"], unit["tree"])):
                for run in runs:
                    if (text := hexes.get(run)) is None:
                        if len(hexes) > BLOCK:
                            hexes.clear()
                        text = hexes[run] = run.hex()
                    levels.append(_siblings(index, text))
                    index //= FAN
            out.append(make(unit, levels, head["subroot"], head["root"]))
            if len(out) == BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return _met(units, manifest.logs, _heads(manifest.logs, tops), 0).mapInArrow(read, schema)


def fold(digest: bytes, levels: list[tuple[str, str]]) -> bytes:
    """The root that a leaf leads to with its siblings."""
    for left, right in levels:
        digest = hashlib.sha256(f"{left}{digest.hex()}{right}".encode()).digest()
    return digest


def read_proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """tree, at, leaf, siblings (left and right of the path by level, as hex text), root: the proof of every leaf, or of those in `wanted` (tree, at)."""

    def make(unit: dict, levels: list[tuple[str, str]], subroot: bytes, root: bytes) -> tuple:
        return unit["tree"], unit["index"], unit["leaf"], [{"left": a, "right": b} for a, b in levels], root

    pair = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    schema = "tree long, at long, leaf binary, siblings array<struct<left:string,right:string>>, root binary"
    return _with_proofs(manifest, wanted, ["leaf"], make, schema, [pa.int64(), pa.int64(), pa.binary(), pair, pa.binary()])


def audit(manifest: Manifest, changed: str) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified for every leaf.

    `changed` names the column of the leaf as it is found today, null where it is as it was. Each is folded
    with the siblings that the log holds; proof_sha256 is the hash of these, level by level and from left to right.
    """
    id_type = dict(manifest.placed.dtypes)["id"]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]

    def make(unit: dict, levels: list[tuple[str, str]], subroot: bytes, root: bytes) -> tuple:
        proof = hashlib.sha256("".join(side for level in levels for side in level).encode()).hexdigest()
        now = unit[changed] if unit[changed] is not None else unit["leaf"]
        folded = fold(now, levels)
        return unit["id"], unit["leaf"].hex(), subroot.hex(), root.hex(), proof, folded.hex(), folded == root

    schema = f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _with_proofs(manifest, None, ["id", "leaf", changed], make, schema, [arrow, *[pa.string()] * 5, pa.bool_()])


_CRC_SQL = """crc as (select list(c order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) as c from range(256) r(i)))"""
_FIELD_SQL = "coalesce(octet_length(encode({0}::varchar))::varchar || ':' || {0}::varchar, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD_SQL.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _up_sql(name: str, units: str) -> str:
    """Nodes (tree, level, i, h, n) of all levels from units (tree, i, h, n), and the runs of each parent."""
    return f"""{name} as (select tree, 0 as level, i, h, n from {units} union all
select tree, level + 1, i // 16, sha256(string_agg(h, '' order by i)), (any_value(n) + 15) // 16 from {name} where n > 1 group by tree, level, i // 16),
{name}_runs as (select tree, level, i // 16 as parent, list(h order by i) as hs from {name} where n > 1 group by all)"""


def _fold_sql(name: str, start: str, runs: str) -> str:
    """Fold rows (row, tree, level, i, own, proof) of `start` up to their root."""
    return f"""{name} as (select row, tree, level, i, own, proof from {start} union all
select row, tree, f.level + 1, i // 16, sha256(array_to_string(hs[:i % 16], '') || own || array_to_string(hs[i % 16 + 2:], '')),
 proof || array_to_string(hs[:i % 16], '') || array_to_string(hs[i % 16 + 2:], '') from {name} f join {runs} r using (tree) where r.level = f.level and r.parent = f.i // 16)"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
MERKLE_SQL = f"""with recursive {_CRC_SQL},
base as (select doc_id, source, {_leaf_sql("text")} as leaf, {_leaf_sql(_LOWER)} as low,
 list_transform(regexp_extract_all(hex(encode(doc_id::varchar)), '..'), lambda h: ('0x' || h)::bigint) as bytes from documents),
judged as (select doc_id, source, leaf, case when xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0 then low else leaf end as now from base cross join crc),
placed as (select *, dense_rank() over (order by source nulls first) - 1 as tree, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by source) as n, row_number() over () as row from judged),
units as (select tree, i, leaf as h, n from placed),
{_up_sql("nodes", "units")},
subroots as (select tree, h from nodes where n = 1),
top_units as (select 0 as tree, tree as i, h, (select count(*) from subroots) as n from subroots),
{_up_sql("tops", "top_units")},
start as (select row, tree, 0 as level, i, now as own, '' as proof from placed),
{_fold_sql("folds", "start", "nodes_runs")},
ends as (select row, arg_max(own, level) as own, arg_max(proof, level) as proof from folds group by row),
top_start as (select row, 0 as tree, 0 as level, placed.tree as i, own, proof from ends join placed using (row)),
{_fold_sql("top_folds", "top_start", "tops_runs")},
top_ends as (select row, arg_max(own, level) as own, arg_max(proof, level) as proof from top_folds group by row)
select doc_id, leaf, s.h as subroot, r.h as root, sha256(proof) as proof_sha256, own as folded_root, own = r.h as verified
from placed p join top_ends using (row) join subroots s on s.tree = p.tree cross join (select h from tops where n = 1) r"""


@query("op12_merkle_manifest", MERKLE_SQL)
def op12_merkle_manifest(spark, sf):
    """Every document's place in the manifest, its proof, and whether it still leads to the root after some texts were lower-cased."""
    docs = table(spark, sf, "documents")
    lead = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, leaf_hash(*lead, lower_ascii(F.col("text"))))
    manifest = build_manifest(docs, "doc_id", "source", leaf_hash(*lead, F.col("text")), changed=changed)
    return audit(manifest, "changed").withColumnRenamed("id", "doc_id")
