"""Merge, children, windows and sampling, with hot keys."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lexmill import schemas
from lexmill.operators import ingest
from lexmill.operators.skew import hash_rank, lag_sliced, order_slices, spread

NOW = datetime(2026, 1, 1)
ITEM = "url string, seq long, type string, title string, status string, is_valid int, text_hash string, raw_text string"


def batch(spark, rows):
    items = spark.createDataFrame([(u, s, "LEY", t, "VIGENTE", v, h, f"texto {h}") for u, s, t, v, h in rows], ITEM)
    return schemas.conform(items, schemas.fields(
        url="string!", seq="long", type="string", number="string", title="string", date="date", source="string", status="string",
        is_valid="int", level="int", text_hash="string", raw_text="string"))


def start(spark):
    return schemas.empty(spark, schemas.NORMS), schemas.empty(spark, schemas.VERSIONS)


def test_one_link_in_order(spark):
    """Hashes a, a, b, a: added, unchanged, updated, updated; three versions."""
    rows = [("u", i, f"t{i}", 1, h) for i, h in enumerate("aaba")]
    m = ingest.merge_versions(*start(spark), batch(spark, rows), NOW)
    assert [r["outcome"] for r in m.outcomes.orderBy("seq").collect()] == ["added", "unchanged", "updated", "updated"]
    assert sorted(r["text_hash"] for r in m.versions.collect()) == ["a", "a", "b"]
    norm = m.norms.first()
    assert (norm["title"], norm["last_hash"], norm["id"]) == ("t3", "a", 1)


def test_update_leaves_validity_alone(spark):
    norms, versions = start(spark)
    one = ingest.merge_versions(norms, versions, batch(spark, [("u", 0, "t", 0, "a")]), NOW)
    assert (one.norms.first()["is_valid"], one.norms.first()["validation_message"]) == (0, "VIGENTE")
    later = datetime(2026, 2, 2)
    two = ingest.merge_versions(one.norms, one.versions, batch(spark, [("u", 1, "t2", 1, "b")]), later).norms.first()
    assert (two["is_valid"], two["title"], two["updated_at"], two["created_at"]) == (0, "t2", later, NOW)


def test_unchanged_item_touches_nothing(spark):
    one = ingest.merge_versions(*start(spark), batch(spark, [("u", 0, "t", 1, "a")]), NOW)
    two = ingest.merge_versions(one.norms, one.versions, batch(spark, [("u", 1, "other", 1, "a")]), datetime(2026, 2, 2))
    assert two.norms.collect() == one.norms.collect() and two.versions.count() == 1


def test_merging_the_same_state_again_is_unchanged(spark):
    rows = [(f"u{i % 7}", i, f"t{i}", i % 2, str(i % 7)) for i in range(40)]
    one = ingest.merge_versions(*start(spark), batch(spark, rows), NOW)
    two = ingest.merge_versions(one.norms, one.versions, batch(spark, rows), NOW)
    assert {r["outcome"]: r["n"] for r in ingest.outcome_totals(two.outcomes).collect()} == {"unchanged": 40}
    assert sorted(r["id"] for r in two.norms.collect()) == list(range(1, 8))


def brute_merge(rows, known):
    known, out = dict(known), {}
    for u, s, _, _, h in sorted(rows, key=lambda r: r[1]):
        out[(u, s)] = "added" if u not in known else "updated" if known[u] != h else "unchanged"
        known[u] = h
    return out


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_hot_link_and_partition_count(spark, partitions):
    """A third of the batch on one link; the outcome does not depend on how rows are spread."""
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.34 else f"u{rnd.randrange(60)}", i, "t", 1, rnd.choice("abc")) for i in range(900)]
    norms, versions = start(spark)
    stored = ingest.merge_versions(norms, versions, batch(spark, [("hot", 0, "t", 1, "a"), ("u1", 0, "t", 1, "b")]), NOW)
    m = ingest.merge_versions(stored.norms, stored.versions, batch(spark, rows).repartition(partitions), NOW)
    got = {(r["url"], r["seq"]): r["outcome"] for r in m.outcomes.collect()}
    assert got == brute_merge(rows, {"hot": "a", "u1": "b"})
    assert m.versions.count() == 2 + sum(o != "unchanged" for o in got.values())


def test_sliced_lag_equals_plain_lag(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(9)}", i, rnd.choice(["x", "y", None])) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, s long, v string")
    got = lag_sliced(df, ["k"], ["s"], F.col("v"), order_slices(df, "s", 16), "p")
    last, expected = {}, {}
    for k, s, v in rows:
        expected[s] = last.get(k)
        last[k] = (v,)
    assert {r["s"]: (r["p"] and tuple(r["p"])) for r in got.collect()} == expected


def test_hash_rank_is_exact(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "id long, c int").withColumn("h", F.md5(F.col("id").cast("string")))
    overall = {r["id"]: r["rank"] for r in hash_rank(df, F.col("h")).collect()}
    assert [i for i, _ in sorted(overall.items(), key=lambda x: x[1])] == [r["id"] for r in df.orderBy("h").collect()]
    within = hash_rank(df, F.col("h"), by=["c"])
    assert all(sorted(r["rank"] for r in within.where(F.col("c") == c).collect()) == list(range(1, n + 1)) for c, n in ((0, 167), (1, 167), (2, 166)))
    top = hash_rank(df, F.col("h"), at_most=F.lit(37))
    assert sorted(r["rank"] for r in top.collect()) == list(range(1, 38))


def test_spread_leaves_wide_input_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    narrow, wide = spark.range(0, 100, 1, 1).toDF("id"), spark.range(0, 100, 1, cores + 3).toDF("id")
    assert spread(narrow).rdd.getNumPartitions() == cores and spread(wide) is wide


def test_children_stay_when_nothing_was_found(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "norm_id long, content string")
    new = spark.createDataFrame([(1, "A")], "norm_id long, content string")
    changed = spark.createDataFrame([(1,), (2,)], "norm_id long")
    rows = lambda keep: sorted(r["content"] for r in ingest.replace_children(old, new, changed, keep_when_empty=keep).collect())
    assert rows(True) == ["A", "b", "c"] and rows(False) == ["A", "c"]


def test_version_state(spark):
    v = spark.createDataFrame([(1, 7, NOW), (2, 7, datetime(2025, 1, 1)), (3, 7, NOW), (4, 8, NOW)], "id long, norm_id long, version_date timestamp")
    assert {r["id"]: r["state"] for r in ingest.version_state(v).collect()} == {1: "Modificado", 2: "Inicial", 3: "Modificado", 4: "Inicial"}


def test_latest_version_and_missing(spark):
    n = spark.createDataFrame([(1,), (2,)], "id long")
    v = spark.createDataFrame([(1, 1, NOW, "a"), (2, 1, NOW, "b"), (3, 1, datetime(2020, 1, 1), "c")], "id long, norm_id long, version_date timestamp, raw_text string")
    assert {r["id"]: r["raw_text"] for r in ingest.latest_version(n, v).collect()} == {1: "b", 2: None}


def test_truncate_counts_and_null(spark):
    df = spark.createDataFrame([("x" * 200, None), ("y", "z" * 600)], "type string, status string")
    got = ingest.truncate_fields(df).collect()
    assert [(len(r["type"]), r["status"] and len(r["status"]), r["cut_fields"]) for r in got] == [(128, None, 1), (1, 512, 1)]


def test_pending_and_validation_totals(spark):
    df = spark.createDataFrame([(1, 1, None), (2, None, NOW), (3, 0, NOW)], "id long, is_valid int, validation_date timestamp")
    assert sorted(r["id"] for r in ingest.pending(df).collect()) == [1, 2]
    assert ingest.pending(df, force=True).count() == 3
    seen = spark.createDataFrame([(0, 1, None), (1, 0, None), (1, 1, None), (None, 0, None), (1, 1, "x")], "old int, new int, err string")
    assert tuple(ingest.validation_totals(seen, "old", "new", "err").first()) == (4, 2, 2, 1, 2)


def brute_quota(rows, plan, per_entry, target):
    taken, out = set(), []
    for e, (group, how) in enumerate(plan):
        part = sorted((r for r in rows if r[1] == group), key=lambda r: r[0])
        part.sort(key=lambda r: r[2], reverse=how == "1")
        picked = 0
        for r in part:
            if picked == per_entry or len(out) == target:
                break
            if r[0] not in taken:
                taken.add(r[0])
                picked += 1
                out.append((r[0], e, picked))
    return sorted(out)


@pytest.mark.parametrize("per_entry, target", [(3, 100), (10, 17), (50, 1000)])
def test_quota_sample(spark, per_entry, target):
    """Ids may stand in several groups; one group holds most rows."""
    rnd = random.Random(9)
    rows = list({(rnd.randrange(60), rnd.choice("aaab"), date(2020, 1, 1 + rnd.randrange(28))) for _ in range(150)})
    rows = list({(i, g): (i, g, d) for i, g, d in rows}.values())
    plan = [("a", "1"), ("a", "2"), ("b", "1"), ("a", "1"), ("b", "2")]
    df = spark.createDataFrame(rows, "id long, g string, d date")
    got = sorted(tuple(r) for r in ingest.quota_sample(df, "id", "g", "d", plan, per_entry, target).collect())
    assert got == brute_quota(rows, plan, per_entry, target)


def test_conform_is_repeatable(spark):
    old = spark.createDataFrame([("u",)], "url string")
    once = schemas.conform(old, schemas.NORMS, {"is_valid": 1})
    twice = schemas.conform(once, schemas.NORMS, {"is_valid": 0})
    assert once.collect() == twice.collect() and once.first()["is_valid"] == 1


def test_keep_new_ids(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("", 0), (None, 0), ("b", 5), ("c", 1)], "id string, s int")
    known = spark.createDataFrame([("c",)], "id string")
    assert sorted(tuple(r) for r in ingest.keep_new_ids(df, "id", ["s"], known).collect()) == [("a", 1), ("b", 5)]


def test_null_keys_are_one_key(spark):
    rows = spark.range(200).select(F.lit(None).cast("string").alias("k"), "id", F.lit("same").alias("v"))
    assert ingest.change_points(rows, ["k"], ["id"], "v").count() == 1


def test_tasks_of_costly_work_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr("lexmill.operators.skew.TASK_ROWS", 100)
    assert spread(spark.range(0, 5000, 1, 1)).rdd.getNumPartitions() == 50


def test_items_are_judged_without_their_texts(spark, monkeypatch):
    """What is moved by key to judge items is key, order and hash; rows of equal key and order stay apart."""
    seen, judge = [], ingest.merge_outcomes
    monkeypatch.setattr(ingest, "merge_outcomes", lambda norms, rows, **a: seen.append(rows.columns) or judge(norms, rows, **a))
    rows = batch(spark, [("u", 0, "t", 1, "a"), ("v", 0, "t", 1, "b"), ("u", 1, "t", 1, "c"), ("w", 5, "t", 1, "d"), ("w", 5, "t", 1, "d")])
    m = ingest.merge_versions(*start(spark), rows.withColumn("outcome", F.lit("of the page")), NOW)
    assert seen == [["_row", "url", "seq", "text_hash"]]
    assert sorted((r["url"], r["outcome"], r["raw_text"]) for r in m.outcomes.collect()) == [
        ("u", "added", "texto a"), ("u", "updated", "texto c"), ("v", "added", "texto b"), ("w", "added", "texto d"), ("w", "unchanged", "texto d")]
    assert m.versions.count() == 4 and m.norms.count() == 3


def test_only_parents_with_children_are_asked_again(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "norm_id long, content string")
    new = spark.createDataFrame([(1, "A"), (4, "D")], "norm_id long, content string")
    changed = spark.createDataFrame([(1,), (2,), (4,)], "norm_id long")
    again = new.where("norm_id = 1")
    rows = [sorted(map(tuple, ingest.replace_children(old, new, changed, again=x).collect())) for x in (None, again)]
    assert rows[0] == rows[1] == [(1, "A"), (2, "b"), (3, "c"), (4, "D")]


def test_staging_lets_go_of_shuffle_files(spark, monkeypatch):
    from lexmill import session

    asked, release = [], session.release
    monkeypatch.setattr(session, "release", lambda s: asked.append(s) or release(s))
    assert session.stage(spark.range(10).repartition(3, "id")).count() == 10 and asked == [spark]
