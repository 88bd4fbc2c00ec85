"""Near-duplicate vectors: one hierarchical navigable small-world graph per shard, exact checks, components."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import query, table
from lexmill.llm.components import connected_components
from lexmill.session import stage

#: Distinct vectors of a shard, about, and queries that one copy of its graph answers, about.
SHARD_ROWS, PART_ROWS = 32_768, 65_536
#: Links of a node (twice as many on the ground layer), beam when building, first beam of a query and widest before a full scan.
LINKS, BUILD_BEAM, FIRST_BEAM, WIDEST_BEAM = 16, 48, 32, 256
#: Members of a shard, and vectors of other shards, that audit its beam, how many of each they are chosen from, and shares
#: of their links and of their nearest neighbours that must be found.
AUDITS, AUDIT_POOL, LINK_RECALL, NEAREST_RECALL = 256, 4096, 0.995, 0.9
_BATCH = 256
#: Cosines this far below the threshold in single precision are still checked in double precision.
_SLACK = 1e-4


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


class Graph:
    """HNSW over unit vectors. Nodes stand in order of falling level, so layer l holds the first `sizes[l]` nodes.

    Nodes are inserted in batches. A batch is searched against the graph so far and
    compared with itself, and all its queries advance together in numpy.
    """

    def __init__(self, vectors: np.ndarray, seed: int = 42, links: int = LINKS, beam: int = BUILD_BEAM):
        n = len(vectors)
        levels = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(links)).astype(int)
        self.order = np.argsort(-levels, kind="stable")
        self.unit = _unit(vectors)[self.order]
        top = int(levels.max(initial=0))
        self.sizes = [int((levels >= l).sum()) for l in range(top + 1)]
        self.near = [np.full((size, links * (2 if l == 0 else 1)), -1, np.int32) for l, size in enumerate(self.sizes)]
        at = 0
        while at < n:
            end = min(n, at + min(_BATCH, max(16, at)))
            self._insert(at, end, links, beam)
            at = end

    def _insert(self, start: int, end: int, links: int, beam: int) -> None:
        queries = self.unit[start:end]
        entry = np.zeros((end - start, 1), np.int32)
        for layer in range(len(self.sizes) - 1, -1, -1):
            inside = max(0, min(end, self.sizes[layer]) - start)
            known = min(start, self.sizes[layer])
            found = np.full((end - start, 0), -1, np.int32)
            if known:
                found, _ = self._beam(queries, entry, layer, beam if inside else 1)
                entry = found[:, :max(1, beam // 8)]
            if inside:
                own = self.unit[start:start + inside] @ self.unit[start:start + inside].T
                np.fill_diagonal(own, -np.inf)
                best = np.argsort(-own, axis=1, kind="stable")[:, :links * 2]
                beside = np.where(np.take_along_axis(own, best, 1) > -np.inf, best + start, -1).astype(np.int32)
                nodes = np.arange(start, start + inside)
                self._link(layer, nodes, np.concatenate([found[:inside], beside], axis=1), links)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, layer: int, width: int, stride: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest nodes found for each query, nearest first (-1 where fewer), and their cosines."""
        near, n, b = self.near[layer], self.sizes[layer], len(queries)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, n), bool)
        stamp = np.zeros((b, n), np.int16)
        width = min(width, n)

        def fresh(row: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            """Which nodes are new to their query; of repeats in a row the last counts."""
            safe = np.maximum(nodes, 0)
            new = (nodes >= 0) & ~seen[row, safe]
            place = np.arange(nodes.shape[1], dtype=np.int16)[None].repeat(len(nodes), 0)
            r, c = np.nonzero(new)
            stamp[row[r, 0], safe[r, c]] = place[r, c]
            new[r, c] = stamp[row[r, 0], safe[r, c]] == place[r, c]
            seen[row[r, 0], safe[r, c]] = True
            return new

        new = fresh(rows, entry)
        cos = np.where(new, np.einsum("bd,bkd->bk", queries, self.unit[np.maximum(entry, 0)]), -np.inf).astype(np.float32)
        ids = np.where(new, entry, -1).astype(np.int32)
        pad = max(0, width - ids.shape[1])
        ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
        cos = np.pad(cos, ((0, 0), (0, pad)), constant_values=-np.inf)
        done = ids < 0
        live = np.arange(b)
        step = min(stride, width)
        while len(live):
            open_cos = np.where(done[live], -np.inf, cos[live])
            pick = np.argpartition(-open_cos, step - 1, axis=1)[:, :step]
            picked = np.take_along_axis(open_cos, pick, 1) > -np.inf
            live, pick, picked = live[picked.any(1)], pick[picked.any(1)], picked[picked.any(1)]
            if not len(live):
                break
            at = live[:, None]
            nodes = np.where(picked, ids[at, pick], -1)
            done[at, pick] = True
            nodes = np.where((nodes >= 0)[:, :, None], near[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
            new = fresh(at, nodes)
            value = np.full(nodes.shape, -np.inf, np.float32)
            r, c = np.nonzero(new)
            value[r, c] = np.einsum("kd,kd->k", queries[live[r]], self.unit[nodes[r, c]])
            all_ids = np.concatenate([ids[live], np.where(new, nodes, -1)], axis=1)
            all_cos = np.concatenate([cos[live], value], axis=1)
            all_done = np.concatenate([done[live], ~new], axis=1)
            keep = np.argpartition(-all_cos, ids.shape[1] - 1, axis=1)[:, :ids.shape[1]]
            ids[live], cos[live], done[live] = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_cos, all_done))
        rank = np.argsort(-cos, axis=1, kind="stable")[:, :width]
        return np.take_along_axis(ids, rank, 1), np.take_along_axis(cos, rank, 1)

    def _choose(self, nodes: np.ndarray, around: np.ndarray, limit: int) -> np.ndarray:
        """Up to `limit` of the nodes `around` each node: first those nearer to it than to one chosen before, then the nearest of the rest."""
        cos = np.where(around >= 0, np.einsum("bd,bkd->bk", self.unit[nodes], self.unit[np.maximum(around, 0)]), -np.inf)
        rank = np.argsort(-cos, axis=1, kind="stable")
        around, cos = np.take_along_axis(around, rank, 1), np.take_along_axis(cos, rank, 1)
        vectors = self.unit[np.maximum(around, 0)]
        between = np.einsum("bid,bjd->bij", vectors, vectors)
        chosen = np.zeros(around.shape, bool)
        for j in range(around.shape[1]):
            apart = ~(chosen & (between[:, j] > cos[:, j, None])).any(axis=1)
            chosen[:, j] = (around[:, j] >= 0) & apart & (chosen.sum(axis=1) < limit)
        first = np.argsort(np.where(chosen, 0, np.where(around >= 0, 1, 2)), axis=1, kind="stable")[:, :limit]
        out = np.take_along_axis(around, first, 1)
        return np.pad(out, ((0, 0), (0, max(0, limit - out.shape[1]))), constant_values=-1)

    def _link(self, layer: int, nodes: np.ndarray, around: np.ndarray, links: int) -> None:
        near = self.near[layer]
        around = np.sort(around, axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1  # each neighbour once
        own = self._choose(nodes, around, links)
        near[nodes, :links] = own
        # Back links: each node that was chosen chooses anew among its links and the newcomers.
        row, col = np.nonzero(own >= 0)
        to, source = own[row, col], nodes[row]
        order = np.lexsort((source, to))
        to, source = to[order], source[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        for a in range(0, len(targets), 1024):
            t, f, c = targets[a:a + 1024], first[a:a + 1024], np.minimum(count[a:a + 1024], 4 * links)
            more = np.full((len(t), int(c.max())), -1, np.int32)
            r = np.repeat(np.arange(len(t)), c)
            k = np.arange(len(r)) - np.repeat(np.cumsum(c) - c, c)
            more[r, k] = source[f[r] + k]
            both = np.sort(np.concatenate([near[t], more], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            near[t] = self._choose(t, both, near.shape[1])

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (in `order`) and cosines of the nearest nodes of unit vectors, from the top layer down."""
        entry = np.zeros((len(queries), 1), np.int32)
        for layer in range(len(self.sizes) - 1, 0, -1):
            entry, _ = self._beam(queries, entry, layer, 4)
        return self._beam(queries, entry, 0, width)


class Shard(NamedTuple):
    """Vectors in graph order with their ids and weights, the graph, and the beam that passed the audit (0: scan all)."""

    ids: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    graph: Graph
    beam: int

    def packed(self) -> bytes:
        """As plain arrays, without the classes of this module."""
        return pickle.dumps((*self[:3], vars(self.graph), self.beam))

    @classmethod
    def unpacked(cls, data: bytes) -> Shard:
        *arrays, state, beam = pickle.loads(data)
        graph = Graph.__new__(Graph)
        vars(graph).update(state)
        return cls(*arrays, graph, beam)


def _scan(shard_unit: np.ndarray, queries: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(queries @ shard_unit.T >= floor)


def _scans(cos: np.ndarray, beam: int, floor: float) -> np.ndarray:
    """Queries whose beam holds so many links that there may be more: they scan the shard."""
    return (cos >= floor).sum(axis=1) >= beam // 2


def _auditors(unit: np.ndarray, pool: np.ndarray, own: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Up to AUDITS rows of `pool`, those with links first, and their cosines to the shard; `own` are the places of members."""
    def cosines(rows: np.ndarray) -> np.ndarray:
        cos = pool[rows] @ unit.T
        if own is not None:
            cos[np.arange(len(rows)), own[rows]] = -np.inf
        return cos

    rows = np.arange(len(pool))
    linked = np.concatenate([(cosines(rows[a:a + _BATCH]) >= threshold).any(axis=1) for a in range(0, len(pool), _BATCH)])
    spread = np.argsort(np.random.default_rng(len(pool)).random(len(pool)) - linked, kind="stable")[:AUDITS]
    return pool[spread], cosines(spread)


def _passes(graph: Graph, queries: np.ndarray, cos: np.ndarray, beam: int, threshold: float) -> bool:
    """Whether queries that would not scan the shard find enough of their links, and enough queries their nearest neighbour.

    Where no such query has a link, nearest neighbours stand for links and as many must be found.
    """
    found, found_cos = graph.search(queries, beam)
    hit = np.zeros(cos.shape, bool)
    r, c = np.nonzero(found >= 0)
    hit[r, found[r, c]] = True
    kept = ~_scans(found_cos, beam, threshold - _SLACK)
    linked = cos >= threshold
    nearest = hit[np.arange(len(cos)), cos.argmax(axis=1)] | ~kept
    if not linked[kept].any():
        return nearest.mean() >= LINK_RECALL
    return (hit & linked)[kept].sum() / linked[kept].sum() >= LINK_RECALL and nearest.mean() >= NEAREST_RECALL


def build_shard(ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray, threshold: float, held_out: np.ndarray | None = None) -> Shard:
    """A graph whose beam is doubled until audits against a full scan find enough links and nearest neighbours.

    Members audit it, and `held_out` vectors, which no node stands for.
    """
    graph = Graph(vectors)
    unit, n = graph.unit, len(ids)
    members = np.unique(np.linspace(0, n - 1, min(n, AUDIT_POOL)).astype(int))
    audits = [_auditors(unit, unit[members], members, threshold)] if n > 1 else []
    if held_out is not None and len(held_out):
        audits.append(_auditors(unit, _unit(held_out), None, threshold))
    beam = FIRST_BEAM
    while beam <= WIDEST_BEAM and not all(_passes(graph, q, cos, beam, threshold) for q, cos in audits):
        beam *= 2
    return Shard(ids[graph.order], weights[graph.order], vectors[graph.order], graph, beam if beam <= WIDEST_BEAM else 0)


def links_of(shard: Shard, vectors: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of `vectors`, position in the shard) of all pairs at `threshold` or above, checked in double precision.

    A query whose beam is half full of links may have more than it holds and scans the shard.
    """
    unit, floor = _unit(vectors), threshold - _SLACK
    step = _BATCH
    for a in range(0, len(unit), step):
        q = unit[a:a + step]
        full = np.ones(len(q), bool)
        if shard.beam:
            ids, cos = shard.graph.search(q, shard.beam)
            full = _scans(cos, shard.beam, floor)
            r, c = np.nonzero((cos >= floor) & ~full[:, None])
            yield from _checked(shard, vectors, r + a, ids[r, c], threshold)
        rest = np.flatnonzero(full)
        block = max(1, (1 << 22) // len(shard.ids))
        for b in range(0, len(rest), block):
            r, c = _scan(shard.graph.unit, q[rest[b:b + block]], floor)
            yield from _checked(shard, vectors, rest[b + r] + a, c, threshold)


def _checked(shard: Shard, vectors: np.ndarray, row: np.ndarray, at: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(0, len(row), 1 << 18):
        r, p = row[i:i + (1 << 18)], at[i:i + (1 << 18)]
        x, y = vectors[r].astype(np.float64), shard.vectors[p].astype(np.float64)
        good = np.einsum("kd,kd->k", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) >= threshold
        yield r[good], p[good]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component): as many links as nodes, whatever the number of pairs."""
    nodes, flat = np.unique(np.r_[a, b], return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def embedding_links(classes: DataFrame, threshold: float, shard_rows: int = SHARD_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """a, b, n for distinct vectors (group, rep, weight, v): a row (rep, rep, links found) per query and shard, and links that span the components (n = 0).

    Groups are cut by a hash into shards of about `shard_rows`; each shard's graph
    is built in one task and written once. Every vector queries every shard of its group;
    the queries of a group are cut into parts of about `part_rows`, each with a copy of the graph.
    """
    sizes = stage(classes.groupBy("group").agg(F.count(F.lit(1)).alias("rows")), "group-sizes")
    shards, parts = (F.ceil(F.col("rows") / k).cast("int") for k in (shard_rows, part_rows))
    placed = classes.join(sizes, "group").withColumns({"shards": shards, "parts": parts}).drop("rows").withColumns({
        "shard": F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"),
        "part": F.pmod(F.xxhash64("rep", F.lit(1)), F.col("parts")).cast("int")})
    placed = stage(placed, "placed")

    # About AUDIT_POOL vectors of a group audit the shards in which they do not stand.
    pool = placed.where(F.pmod(F.xxhash64("rep", F.lit(2)), F.col("shards").cast("long") * shard_rows) < AUDIT_POOL)
    held = pool.withColumnRenamed("shard", "own").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("shard <> own").drop("own")
    seen = placed.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        out = np.flatnonzero(frame["held"].to_numpy())
        own = frame[~frame["held"]]
        if not len(own):
            return pd.DataFrame({"group": [], "shard": [], "parts": [], "graph": []})
        vectors = own["v"].to_numpy()
        held_out = np.stack(frame["v"].to_numpy()[out]) if len(out) else None
        shard = build_shard(own["rep"].to_numpy(), own["weight"].to_numpy(), np.stack(vectors), threshold, held_out)
        return pd.DataFrame({"group": own["group"].iloc[:1], "shard": own["shard"].iloc[:1], "parts": own["parts"].iloc[:1], "graph": [shard.packed()]})

    graphs = stage(seen.groupBy("group", "shard").applyInPandas(build, "group long, shard int, parts int, graph binary"), "graphs")
    # Graph and queries of a part meet in one task, the graph first.
    copies = graphs.select("group", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "graph",
                           F.lit(None).cast("long").alias("rep"), F.lit(None).cast(placed.schema["v"].dataType).alias("v"))
    asks = placed.select("group", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "part", F.lit(None).cast("binary").alias("graph"), "rep", "v")
    keys = ["group", "shard", "part"]
    met = copies.union(asks).repartition(*keys).sortWithinPartitions(*keys, F.col("graph").isNull())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            graph = batch.column(3)
            cuts = [*np.flatnonzero(graph.is_valid().to_numpy(zero_copy_only=False)).tolist(), len(batch)]
            spans = [(0, cuts[0]), *[(c + 1, d) for c, d in zip(cuts, cuts[1:])]]
            for number, (start, end) in enumerate(spans):
                if number:
                    shard = Shard.unpacked(graph[cuts[number - 1]].as_py())
                if start == end:
                    continue
                rep = batch.column(4).slice(start, end - start).to_numpy()
                lists = batch.column(5).slice(start, end - start)
                vectors = lists.flatten().to_numpy().reshape(len(rep), -1)
                counts = np.zeros(len(rep), np.int64)
                for row, at in links_of(shard, vectors, threshold):
                    other = shard.ids[at] != rep[row]
                    row, at = row[other], at[other]
                    np.add.at(counts, row, shard.weights[at])
                    a, b = _forest(rep[row], shard.ids[at])
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), np.int64))], ["a", "b", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(rep), pa.array(counts)], ["a", "b", "n"])

    return met.mapInArrow(answer, "a long, b long, n long")


def embedding_components(df: DataFrame, id: str, vector: str, label: str, threshold: float = 0.93) -> DataFrame:
    """id, n_links, component_id, kept: one row for each row of `df`.

    Rows link if their labels are equal and the cosine of their vectors, in double
    precision, is `threshold` or more. Equal vectors of a label form one class that
    stands in the graph once and counts as often as it occurs. A null label, and a vector that is
    null, empty or zero or holds a null or non-finite component, links with
    nothing; nor do vectors of different lengths. kept is true for the row whose id is the smallest of its component; a row with a null id
    takes part as a copy of its class and is not kept, or is alone (null component) if no row of its class has an id. Repeated rows count as further rows.
    Links are searched for approximately: every row is indexed, and beams widen until audits against full scans pass.
    """
    group = F.xxhash64(F.col(label).cast("string"), F.size(vector))
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("v"), F.when(F.col(label).isNotNull() & _usable(F.col(vector)), group).alias("group"))
    key = F.xxhash64("v", F.lit(7))
    rows = stage(rows.withColumn("key", F.struct(key.alias("x"), F.xxhash64("v").alias("y"))), "vectors")
    classes = rows.where(F.col("group").isNotNull()).groupBy("group", "key").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v"))
    classes = stage(classes.where(F.col("rep").isNotNull()), "classes")
    found = stage(embedding_links(classes, threshold), "found")
    counts = found.groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "rep")
    components = connected_components(found.where(F.col("a") != F.col("b")), "a", "b").withColumnRenamed("node", "rep")
    by_class = classes.select("group", "key", "rep", "weight").join(counts, "rep", "left").join(components, "rep", "left")
    by_class = by_class.select("group", "key", F.coalesce("component", "rep").alias("class_component"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"))
    placed = rows.select("id", "group", "key").join(by_class, ["group", "key"], "left")
    component = F.coalesce("class_component", "id")
    return placed.select(F.col("id").alias(id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


@query("op9_embedding_near_dedup", """with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null
and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select a, b from l union select reach.a, l.b from reach join l on reach.b = l.a),
c as (select a, least(a, min(b)) as component_id from reach group by a),
n as (select a, count(*) as n_links from l group by a)
select vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, vec_id) as component_id, vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join c on c.a = vec_id left join n on n.a = vec_id""")
def op9_embedding_near_dedup(spark, sf):
    """Links and components of all vectors at a cosine of 0.93."""
    return embedding_components(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
