import random

import numpy as np
import pytest
import xxhash
from llm_fixtures import odd_documents, union_find, without_rows

from lexmill.llm import embeddings, simhash
from lexmill.llm.components import connected_components


def test_components_of_a_graph_with_a_hot_node(spark):
    rng = random.Random(1)
    links = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)]
    expected = union_find({n for l in links for n in l}, links)
    df = spark.createDataFrame(links + [(5, 5), (None, 3), (4, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    assert got == {n: c for n, c in expected.items() if n in got} and {a for a, b in links if a != b} <= set(got)
    assert connected_components(without_rows(df), "a", "b").count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_equals_brute_force(spark):
    rng = random.Random(2)
    base = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(300)]
    texts = []
    for _ in range(60):  # a dense group of near copies
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(300)] = "zz"
        texts.append(" ".join(words))
    df = odd_documents(spark, texts + ["one two", "One TWO", "a b c d"])
    rows = df.select("doc_id", "text").collect()
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in rows]
    assert len({f for _, f in prints}) > 20
    links = [(f, g) for _, f in prints for _, g in prints if f < g and (f ^ g).bit_count() <= 4]
    label = union_find({f for _, f in prints}, links)
    smallest = {}
    for d, f in prints:
        if d is not None:
            smallest[label[f]] = min(d, smallest.get(label[f], d))
    expected = sorted(((d, f"{f:016x}", smallest.get(label[f])) for d, f in prints), key=repr)
    found = simhash.simhash_components(df, "doc_id", "text")
    got = found.select("doc_id", simhash.hex_fingerprint(found["fp"]), "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected
    kept = simhash.keep_one_of_each(df, "doc_id", "text")
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(smallest.values())) and ids.count(None) == 1
    assert simhash.keep_one_of_each(without_rows(df), "doc_id", "text").count() == 0


@pytest.mark.parametrize("segments, block", [(2, 10_000), (3, 10_000), (3, 8), (4, 16)])
def test_any_segments_and_blocks_connect_the_same(spark, segments, block):
    rng = random.Random(5)
    center = rng.getrandbits(64)
    prints = {center}
    for _ in range(150):
        f = center
        for _ in range(rng.randint(1, 6)):
            f ^= 1 << rng.randrange(64)
        prints.add(f)
    prints |= {rng.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    rows = [(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(prints)]
    links = [(i, j) for i, f in enumerate(prints) for j, g in enumerate(prints) if i < j and (f ^ g).bit_count() <= 4]
    expected = union_find(range(len(prints)), links)
    found = [(r["a"], r["b"]) for r in simhash.near_links(spark.createDataFrame(rows, "fp long, rep long"), 4, segments, block).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in found)
    assert union_find(range(len(prints)), found) == expected


def clustered(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n // 12, dims))
    x = centers[rng.integers(0, len(centers), n)] + rng.normal(scale=0.12, size=(n, dims))
    x[: n // 3] = centers[0] + rng.normal(scale=0.1, size=(n // 3, dims))  # one hot group
    return x.astype(np.float32)


def test_graph_finds_nearly_all_links():
    x = clustered(3000, 1)
    shard = embeddings.build_shard(np.arange(len(x)), np.ones(len(x), np.int64), x, 0.93)
    shard = embeddings.Shard.unpacked(shard.packed())
    found = {(int(r), int(shard.ids[p])) for rows, at in embeddings.links_of(shard, x, 0.93) for r, p in zip(rows, at)}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    exact = {(int(a), int(b)) for a, b in zip(*np.nonzero(unit @ unit.T >= 0.93))}
    assert found <= exact and len(found) >= 0.98 * len(exact)


@pytest.mark.parametrize("shard_rows", [10_000, 40])
def test_vectors_against_all_pairs(spark, monkeypatch, shard_rows):
    whole = embeddings.embedding_links
    monkeypatch.setattr(embeddings, "embedding_links", lambda classes, t: whole(classes, t, shard_rows, 50))
    x = clustered(150, 3)
    rows = [(i, v.tolist(), 1 if i % 5 else 2) for i, v in enumerate(x)]
    rows += [(500, x[0].tolist(), 2), (500, x[0].tolist(), 2), (501, (x[0] * 2).tolist(), 2), (None, x[0].tolist(), 2)]
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 16, 1), (603, [None] + [1.0] * 15, 1), (604, [float("nan")] + [1.0] * 15, 1), (605, [float("inf")] * 16, 1),
             (606, x[1].tolist(), None), (607, [1.0, 0.0], 1), (608, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "vec_id long, embedding array<float>, label int, key string, rep string")
    usable = lambda v: v and all(c is not None and np.isfinite(c) for c in v) and any(v)
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if usable(v) else None for _, v, _ in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and unit[i] is not None and unit[j] is not None
              and rows[i][2] == rows[j][2] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    label = union_find(range(len(rows)), linked)
    smallest = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            smallest[label[i]] = min(d, smallest.get(label[i], d))
    count = [0] * len(rows)
    for i, _ in linked:
        count[i] += 1
    expected = sorted(((d, count[i], smallest[label[i]], d == smallest[label[i]]) for i, (d, _, _) in enumerate(rows)), key=repr)
    got = sorted((tuple(r) for r in embeddings.embedding_components(df, "vec_id", "embedding", "label").collect()), key=repr)
    assert got == expected
    assert embeddings.embedding_components(without_rows(df), "vec_id", "embedding", "label").count() == 0
