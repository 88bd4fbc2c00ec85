"""Datasets, TF-IDF, reports and attribution against plain computations."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import classify, dataset, features, forest


def labelled(spark, few, many):
    return spark.range(few + many).withColumn("label", (F.col("id") >= few).cast("int"))


@pytest.fixture(scope="module")
def balanced(spark):
    return dataset.balance(labelled(spark, 430, 3000), "label", "id").persist()


def test_balance_keeps_ratio(balanced):
    assert {r["label"]: r["n"] for r in dataset.class_counts(balanced, "label").collect()} == {0: 430, 1: 645}


def test_balance_is_reproducible(spark, balanced):
    again = dataset.balance(labelled(spark, 430, 3000).repartition(7), "label", "id")
    assert sorted(r["id"] for r in again.collect()) == sorted(r["id"] for r in balanced.collect())


def test_exact_split(spark, balanced):
    parts = dataset.stratified_split(balanced, "label", "id", exact=True)
    counts = {(r["label"], r["part"]): r["n"] for r in parts.groupBy("label", "part").agg(F.count("*").alias("n")).collect()}
    assert counts == {(0, "test"): 65, (1, "test"): 97, (0, "train"): 365, (1, "train"): 548}


def test_hash_split_is_near_its_share(spark):
    parts = dataset.stratified_split(labelled(spark, 10000, 10000), "label", "id")
    for r in parts.groupBy("label").agg(F.avg((F.col("part") == "test").cast("int")).alias("s")).collect():
        assert abs(r["s"] - 0.15) < 0.02


def test_folds_are_level_within_classes(spark, balanced):
    dealt = dataset.stratified_folds(balanced, "label", "id")
    assert sorted(r["n"] for r in dealt.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()) == [86] * 5 + [129] * 5


def test_weights_and_small_classes(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 3 + [(9,)] * 8, "level int")
    assert {r["level"]: r["weight"] for r in dataset.class_weights(df, "level").collect()} == {1: 17 / 18, 2: 17 / 9, 9: 17 / 24}
    assert {r["level"] for r in dataset.keep_common_classes(df, "level", 5, 1, 5).collect()} == {1}
    with pytest.raises(ValueError):
        dataset.require_rows(df, 20)
    dataset.require_rows(df, 17)


DOCS = [(0, "agua clara agua"), (1, "agua turbia"), (2, "clara de huevo"), (3, "x"), (4, "agua clara agua clara")]


def brute_tfidf(docs, vocab, min_df):
    grams = {}
    for i, t in docs:
        words = [w for w in t.split() if len(w) > 1]
        grams[i] = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    df = Counter(g for c in grams.values() for g in c)
    total = sum(grams.values(), Counter())
    top = sorted((g for g in df if df[g] >= min_df), key=lambda g: (-total[g], g))[:vocab]
    out = {}
    for i, c in grams.items():
        w = {g: (1 + math.log(c[g])) * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for g in top if g in c}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, g): x / norm for g, x in w.items()})
    return out, sorted(top)


@pytest.mark.parametrize("vocab, min_df", [(100, 1), (3, 2)])
def test_tfidf(spark, vocab, min_df):
    df = spark.createDataFrame(DOCS, "id long, t string")
    rows = features.tfidf(df, "id", "t", vocab, min_df).collect()
    expected, top = brute_tfidf(DOCS, vocab, min_df)
    assert {(r["doc_id"], r["term"]): pytest.approx(r["weight"]) for r in rows} == expected
    assert all(top[r["idx"]] == r["term"] for r in rows)


def test_assembled_vectors(spark):
    df = spark.createDataFrame(DOCS, "id long, t string").withColumnRenamed("id", "doc_id")
    weights = features.tfidf(df, "doc_id", "t", 10, 2)
    got = {r["doc_id"]: r["features"] for r in features.assemble(df.select("doc_id"), weights, 10).collect()}
    assert got[3].numNonzeros() == 0 and got[3].size == 10
    for r in weights.collect():
        assert got[r["doc_id"]][r["idx"]] == pytest.approx(r["weight"])


def test_report(spark):
    pairs = [(0, 0)] * 56 + [(0, 1)] * 9 + [(1, 0)] * 2 + [(1, 1)] * 95
    report = classify.classification_report(classify.confusion(spark.createDataFrame(pairs, "label int, prediction int")))
    got = {r["class"]: tuple(round(r[c], 4) for c in ("precision", "recall", "f1")) + (r["support"],) for r in report.collect()}
    assert got == {
        "0": (0.9655, 0.8615, 0.9106, 65), "1": (0.9135, 0.9794, 0.9453, 97), "accuracy": (0.9321, 0.9321, 0.9321, 162),
        "macro avg": (0.9395, 0.9205, 0.9279, 162), "weighted avg": (0.9343, 0.9321, 0.9313, 162),
    }


def test_confusion_lists_empty_pairs(spark):
    df = spark.createDataFrame([(1, 1), (1, 3)], "label int, prediction int")
    assert sorted(map(tuple, classify.confusion(df, classes=[1, 2, 3]).collect())) == [
        (1, 1, 1), (1, 2, 0), (1, 3, 1), (2, 1, 0), (2, 2, 0), (2, 3, 0), (3, 1, 0), (3, 2, 0), (3, 3, 0)]


def test_linear_attribution(spark):
    x = {(0, "a"): 0.5, (1, "a"): 1.0, (1, "b"): 0.2}
    coef, n = {"a": 2.0, "b": -3.0}, 4
    rows = classify.linear_attribution(
        spark.createDataFrame([(d, t, v) for (d, t), v in x.items()], "doc_id long, term string, weight double"),
        spark.createDataFrame(list(coef.items()), "term string, coef double"), n).collect()
    for r in rows:
        col = [x.get((d, r["term"]), 0.0) for d in range(n)]
        mean = sum(col) / n
        assert r["attribution"] == pytest.approx(sum(abs(coef[r["term"]] * (v - mean)) for v in col) / n)


@pytest.fixture(scope="module")
def notes(spark):
    """Articles whose published text says when they are repealed and whose body does not."""
    rows = []
    for i in range(120):
        body = f"artículo sobre {['agua', 'minas', 'pesca', 'salud'][i % 4]} y trámite {i % 7}"
        rows.append((i, int(i % 3 > 0), body, body + ("" if i % 3 else " nota derogado por la ley")))
    return spark.createDataFrame(rows, "id long, label int, text string, raw_text string")


def test_training_end_to_end(spark, notes, tmp_path):
    docs = notes.withColumnRenamed("id", "doc_id")
    postings = features.ngram_postings(docs, "doc_id", "raw_text")
    trained = classify.fit_text_model(docs.select("doc_id", "label"), postings, "label", 500, 2, classify.train_logreg)
    pred = classify.score(trained, docs.select("doc_id", "label"), postings)
    assert classify.f1_of(pred) == 1.0 and classify.in_force_only(pred).count() == 80
    assert "derogado" in {r["term"] for r in classify.linear_shap(trained, docs, postings, 10).collect()}
    classify.save_model(trained.model, str(tmp_path / "m"))
    scores = classify.cross_validate(docs.select("doc_id", "label"), postings, "label", classify.train_logreg, folds=3, vocab=500)
    stats = classify.fold_stats(scores).first()
    assert stats["mean"] == 1.0 and stats["std"] == 0.0


def test_forest(spark, notes):
    docs = notes.withColumnRenamed("id", "doc_id")
    postings = features.ngram_postings(docs, "doc_id", "raw_text")
    trained = classify.fit_text_model(docs.select("doc_id", "label"), postings, "label", 200, 2, lambda v, l: classify.train_forest(v, l, trees=20, depth=6))
    assert classify.f1_of(classify.score(trained, docs.select("doc_id", "label"), postings), positive=None) > 0.95
    top = classify.forest_importance(trained, 5).collect()
    assert len(top) == 5 and any("derogado" in r["term"] or "nota" in r["term"] for r in top)


def test_rows_do_not_move_by_class(spark):
    """Two classes among many rows: weights, quotas and class counts come to the rows, which stay in all their tasks."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = spark.range(0, 4000, 1, 8).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"))
        tasks = lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks(classify.weighted(rows, "label")) == 8
        assert tasks(dataset.keep_common_classes(rows, "label")) == 8
        assert tasks(dataset.stratified_split(rows, "label", "doc_id", exact=True)) > 2
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_turns_of_cross_validation_share_one_pass(spark, monkeypatch):
    """Vectors of a turn equal those fitted for it alone, and postings do not move by document for each turn."""
    words = "ley norma decreto artículo código plazo multa"
    texts = [(i, i % 2, " ".join(words.split()[(i * j) % 7] for j in range(1, 3 + i % 5)) if i % 11 else "") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, label int, text string")
    postings = features.ngram_postings(docs, "doc_id", "text")
    halves = [F.col("doc_id") < 30, F.col("doc_id") >= 20]
    vocabularies = [features.fit_vocabulary(postings.where(h), 30, 12, 2) for h in halves]
    packed, slots = features.pack(docs.select("doc_id", "label"), postings, vocabularies)
    for v in vocabularies:
        size = v.count()
        alone = {r["doc_id"]: r["features"] for r in features.assemble(docs.select("doc_id"), features.tfidf_weights(postings, v), size).collect()}
        shared = {r["doc_id"]: r["features"] for r in features.assemble_packed(packed, slots, v, size).collect()}
        assert len(alone) == len(shared) == 60
        for k, a in alone.items():
            assert list(a.indices) == list(shared[k].indices) and a.size == shared[k].size
            assert a.values == pytest.approx(shared[k].values, abs=1e-12)

    def moved(*_):
        raise AssertionError("postings moved by document for one turn")

    monkeypatch.setattr(classify, "tfidf_weights", moved)
    scores = classify.cross_validate(docs.select("doc_id", "label"), postings, "label", classify.train_logreg, folds=2)
    assert [r["fold"] for r in scores.orderBy("fold").collect()] == [0, 1]


def test_ngrams_are_counted_without_moving_them(spark):
    docs = spark.createDataFrame([(1, "la ley la ley"), (2, "la ley"), (2, "la norma"), (None, "ley"), (None, "ley"), (3, None)], "doc_id long, text string")
    words = lambda t: (t or "").split()
    want = Counter((r["doc_id"], g) for r in docs.collect() for w in [words(r["text"])] for g in [*w, *[f"{a} {b}" for a, b in zip(w, w[1:])]])
    assert {(r["doc_id"], r["term"]): r["n"] for r in features.ngram_counts(docs, "doc_id", "text").collect()} == want
    once = features.ngram_counts(docs.where("doc_id = 1"), "doc_id", "text")
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()


def test_forest_is_the_same_however_rows_are_dealt(spark, notes, monkeypatch):
    """Blocks, tasks and the level at which slots are written leave model and predictions as they are; most values are zeros and are not held."""
    docs = notes.withColumnRenamed("id", "doc_id").select("doc_id", (F.col("doc_id") % 3).cast("int").alias("label"), "raw_text")
    postings = features.ngram_postings(docs, "doc_id", "raw_text")
    found = []
    for parts, rows, kept in ((1, 1000, 5), (7, 11, 1)):
        monkeypatch.setattr(forest, "BLOCK_ROWS", rows)
        monkeypatch.setattr(forest, "KEPT_LEVELS", kept)
        grown = lambda v, l: classify.train_forest(v.repartition(parts), l, trees=9, depth=7)  # noqa: B023, E731
        trained = classify.fit_text_model(docs.select("doc_id", "label"), postings, "label", 200, 1, grown)
        pred = classify.score(trained, docs.select("doc_id", "label"), postings)
        found.append((sorted(map(tuple, pred.select("doc_id", "label", "prediction").collect())), trained.model.featureImportances, [[list(c) for c in s] for s in trained.model.splits]))
    assert found[0] == found[1] and len(found[0][0]) == 120
    assert abs(sum(found[0][1].values) - 1) < 1e-9


def test_forest_takes_the_best_split():
    """Counts of sparse values against the gain of every split of every feature, zeros as bin 0."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        classes, draw, n, weights = 3, 4, 40, np.array([0.5, 1.0, 2.5])
        bins, label, node = rng.integers(0, 4, (n, draw)) * rng.integers(0, 2, (n, draw)), rng.integers(0, classes, n), rng.integers(0, 3, n)
        counts = np.zeros((3, classes), np.int64)
        np.add.at(counts, (node, label), 1)
        row, j = np.nonzero(bins)
        key = (j * (forest.BINS + 1) + bins[row, j]) * classes + label[row]
        got = forest._best_splits(node[row], key, np.ones(len(row), np.int64), counts, weights, draw)
        gini = lambda c: 1 - sum((c * weights / (c * weights).sum()) ** 2) if c.sum() else 0.0  # noqa: B023, E731
        for m in range(3):
            best = (0.0, 0, 0)
            for f in range(draw):
                for b in range(1, 4):
                    right = np.bincount(label[(node == m) & (bins[:, f] >= b)], minlength=classes)
                    left, s = counts[m] - right, lambda c: (c * weights).sum() / (counts[m] * weights).sum()  # noqa: B023
                    if right.sum() and left.sum():
                        best = max(best, (round(gini(counts[m]) - s(right) * gini(right) - s(left) * gini(left), 10), -f, -b))
            mine = [(round(g, 10), f, b) for own, f, b, g in zip(*got[:4]) if own == m]
            assert [x[0] for x in mine] == ([best[0]] if best[0] > 0 else [])


def test_weights_are_made_where_counts_lie(spark, monkeypatch):
    """Documents do not move by id for their weights; ids on several rows are one document, as in the counts, and rows without words have none."""
    from collections import defaultdict

    monkeypatch.setattr(features, "SLICE_WORDS", 4)
    rows = [(1, "la ley la ley", 5), (2, "la ley", None), (2, "la norma", None), (None, "ley", 7), (None, "ley x", 7), (3, None, 1), (4, "", 1), (5, "norma de la ley de la norma", 2)]
    docs = spark.createDataFrame(rows, "id long, t string, mark long").repartition(3)
    texts = defaultdict(Counter)
    for i, t, _ in rows:
        w = [x for x in (t or "").split() if len(x) > 1]
        texts[i].update([*w, *[f"{a} {b}" for a, b in zip(w, w[1:])]])
    df = Counter(g for c in texts.values() for g in c)
    weights = {(i, g): (1 + math.log(c[g])) * (math.log((1 + len(rows)) / (1 + df[g])) + 1) for i, c in texts.items() for g in c if df[g] >= 2}
    norm = {i: math.sqrt(sum(w * w for (j, _), w in weights.items() if j == i)) for i in texts}
    got = features.tfidf(docs, "id", "t", 50, 2, keep=["mark"]).collect()
    assert {(r["doc_id"], r["term"]): pytest.approx(r["weight"]) for r in got} == {(i, g): w / norm[i] for (i, g), w in weights.items()}
    assert len(got) == len(weights) and {r["doc_id"]: r["mark"] for r in got} == {1: 5, 2: None, None: 7, 5: 2}
    alone = features.tfidf(docs.where("id in (1, 5)"), "id", "t", 50, 1)
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString() and "Window" not in alone._jdf.queryExecution().executedPlan().toString()


def test_first_by_digest_takes_what_the_rank_takes(spark):
    """Balancing and the exact split take the rows that a rank of all rows takes, without moving them; rows of one id are parted to the row."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 > 0).cast("int").alias("label"), F.lit("x").alias("text"))
    digest = dataset.seeded_digest("doc_id")
    for quotas in ({0: 0, 1: 2000}, {0: 137, 1: 700}, {0: 5000, 1: 1}):
        ranked = dataset.hash_rank(rows, digest, by=["label"]).collect()
        want = {r["doc_id"] for r in ranked if r["rank"] <= quotas[r["label"]]}
        assert {r["doc_id"] for r in rows.where(dataset.first_by_digest(rows, "label", digest, quotas)).collect()} == want
    for df in (dataset.balance(rows, "label", "doc_id"), dataset.stratified_split(rows, "label", "doc_id", exact=True)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert dataset.balance(rows, "label", "doc_id").count() == 2500
    twice = rows.withColumn("doc_id", F.col("doc_id") % 30)
    assert dataset.balance(twice, "label", "doc_id", 0.777).groupBy("label").count().orderBy("label").collect() == [(0, 1000), (1, 777)]
    parts = dataset.stratified_split(twice, "label", "doc_id", exact=True).groupBy("label", "part").count().collect()
    assert {(r[0], r[1]): r[2] for r in parts} == {(0, "test"): 150, (0, "train"): 850, (1, "test"): 300, (1, "train"): 1700}


def test_vectors_are_made_where_counts_lie(spark, monkeypatch):
    """Vectors, vocabulary and weights of counted documents equal those of moved postings; each row is a document, though its id stands on several."""
    monkeypatch.setattr(features, "SLICE_WORDS", 6)
    monkeypatch.setattr(features, "SLICES_AT_ONCE", 2)
    words = "ley norma decreto artículo código plazo multa".split()
    texts = [(i, i % 2, ["train", "test", "train"][i % 3], " ".join(words[(i * j) % 7] for j in range(1, 3 + i % 5)) if i % 11 else [None, ""][i % 2]) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, label int, part string, text string").repartition(3)
    counted = features.count_ngrams(docs, "doc_id", "text", "part", ["label"])
    train = docs.where("part = 'train'")
    postings = features.ngram_postings(train, "doc_id", "text")
    vocabulary = features.fit_vocabulary(postings, train.count(), 12, 2)
    got = counted.of("train").vocabulary(train.count(), 12, 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, vocabulary.collect()))
    for part in ("train", "test"):
        rows = docs.where(F.col("part") == part)
        weights = features.tfidf_weights(features.ngram_postings(rows, "doc_id", "text"), vocabulary)
        want = {r["doc_id"]: r["features"] for r in features.assemble(rows.select("doc_id"), weights, 12).collect()}
        made = {r["doc_id"]: r["features"] for r in counted.of(part).vectors(vocabulary, 12).collect()}
        assert want.keys() == made.keys() == {r[0] for r in counted.of(part).docs().collect()}
        for k, v in want.items():
            assert v.size == made[k].size and list(v.indices) == list(made[k].indices) and made[k].values == pytest.approx(v.values)
        assert {(r["doc_id"], r["term"]): pytest.approx(r["weight"]) for r in weights.collect()} == {(r["doc_id"], r["term"]): r["weight"] for r in counted.of(part).weights(vocabulary).collect()}
    twice = features.count_ngrams(docs.unionAll(docs), "doc_id", "text", "part", ["label"]).of("train")
    trained = classify.fit_text_model(twice.docs(), twice, "label", 12, 2, classify.train_logreg)
    assert classify.score(trained, twice.docs(), twice).count() == 80


def test_training_moves_no_posting(spark, notes, monkeypatch):
    """Queries and the ablation fit, cross-validate and score documents counted in slices; all folds share one count."""
    from lexmill.plans import learning

    def moved(*_):
        raise AssertionError("postings moved by document")

    for module, name in ((classify, "assemble"), (classify, "pack"), (classify, "tfidf_weights"), (features, "ngram_postings")):
        monkeypatch.setattr(module, name, moved)
    made = []
    counts = features._counted_slices
    monkeypatch.setattr(features, "_counted_slices", lambda *a: made.append(a) or counts(*a))
    docs = notes.withColumnRenamed("id", "doc_id").select("doc_id", "label", "raw_text")
    train, test = learning._parts(docs, "raw_text")
    pred = classify.score(classify.fit_text_model(*train, "label", 500, 2, classify.train_logreg), *test)
    assert classify.f1_of(pred) == 1.0 and pred.count() + train[0].count() == 120
    rows = classify.ablate(notes, "id", "label", ["raw_text", "text"], vocab=500, folds=3).collect()
    assert [(r["text"], r["cv_mean"], r["cv_std"], r["test_f1"]) for r in rows][0] == ("raw_text", 1.0, 0.0, 1.0)
    assert rows[1]["cv_mean"] < 1 and len(made) == 3
