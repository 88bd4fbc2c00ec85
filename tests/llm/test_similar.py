"""The pipeline's near-duplicate stage against all pairs of texts."""

import random

import numpy as np
import xxhash
from llm_fixtures import odd_documents, union_find, without_rows
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import similar
from lexmill.llm.simhash import fingerprint


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_components(texts):
    """Smallest id of the component of each id of `texts`, over all pairs of texts."""
    sets = {d: shingles(t) for d, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))]
    return union_find(sets, links)


def mixed_texts(seed):
    """Changed copies around the threshold, a dense group, a chain and short texts."""
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        words = [str(rng.randrange(10_000)) for _ in range(rng.randint(60, 400))]
        out.append(" ".join(words))
        for _ in range(2):
            copy = list(words)
            for _ in range(rng.randint(0, len(words) // 30)):
                copy[rng.randrange(len(copy))] = "x"
            out.append(" ".join(copy))
    chain = [str(rng.randrange(10_000)) for _ in range(230)]
    out += [" ".join(chain[i:i + 150]) for i in range(0, 80, 10)]
    dense = [str(rng.randrange(10_000)) for _ in range(200)]
    for _ in range(40):
        dense[rng.randrange(200)] = "y"
        out.append(" ".join(dense))
    return out + ["one two", "One TWO", "", "  ", "a b c d e", "a b c d e f"]


def test_stage_equals_all_pairs_and_finds_what_four_bits_do_not(spark):
    texts = mixed_texts(4)
    expected = plain_components(dict(enumerate(texts)))
    far = [(i, c) for i, c in expected.items() if i != c and (fingerprint(texts[i].encode()) ^ fingerprint(texts[c].encode())).bit_count() > 4]
    assert len(far) > 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("more", F.lit(1)).repartition(5)
    found = similar.similar_components(df, "doc_id", "text")
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == expected
    kept = corpus_pipeline.simhash_near_dedup(spark, df, "")
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))


def test_odd_rows(spark):
    df = odd_documents(spark, ["one two", "One TWO", "a b c d"])
    kept = similar.keep_one_of_similar(df, "doc_id", "text").collect()
    ids = [r["doc_id"] for r in kept]
    assert len({i for i in ids if i is not None}) == len([i for i in ids if i is not None])
    assert {shingles(r["text"]) for r in df.collect()} == {shingles(r["text"]) for r in kept}
    assert similar.keep_one_of_similar(without_rows(df), "doc_id", "text").count() == 0


def test_bands_meet_nearly_all_pairs_at_the_threshold():
    met = 0
    for seed in range(2000):
        hashes = np.array([xxhash.xxh64_intdigest(f"{seed} {i}") for i in range(100)], np.uint64)
        x, y = np.sort(hashes[:90]), np.sort(hashes[10:])  # 80 of 100 shared
        met += any(a == b for a, b in zip(similar.band_keys(x), similar.band_keys(y)))
    assert met >= 1997


def around_the_threshold(seed, n):
    """Copies of one text with so many changed words that about half of all pairs are near 0.8."""
    rng = random.Random(seed)
    words = [str(rng.randrange(10_000)) for _ in range(300)]
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randint(3, 9)):
            copy[rng.randrange(len(copy))] = str(rng.randrange(10_000))
        out.append(" ".join(copy))
    return out


def test_hot_bucket_in_blocks_and_long_sets_lose_no_link(spark, monkeypatch):
    texts = dict(enumerate(around_the_threshold(3, 160)))
    expected = plain_components(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in similar.similar_components(df, "doc_id", "text").collect()}
    assert found == expected and len(set(expected.values())) > 5
    nodes = similar.sketches(df, "doc_id", "text", 5).persist()
    sets = similar._sets(df, nodes.select("node", "text_key"), "doc_id", "text", 5).persist()
    rows = nodes.select("node", F.col("node").alias("component"), "n", "minima", F.explode("keys").alias("key"))
    ids = {r["node"]: r["doc_id"] for r in nodes.select("node", F.col("id").alias("doc_id")).collect()}
    for long in (similar.LONG, 250):
        monkeypatch.setattr(similar, "LONG", long)
        links = similar.links_within(rows, sets, 0.8, block=16).collect()
        assert union_find(texts, [(ids[r["a"]], ids[r["b"]]) for r in links]) == expected
