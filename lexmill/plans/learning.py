"""Dataset preparation, classification, attribution."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from lexmill.functions.rules import label_article
from lexmill.operators import classify, dataset, features
from lexmill.operators.extract import split_code_articles
from lexmill.plans.corpus import codes
from lexmill.plans.generators import grams_sql
from lexmill.plans.registry import query, table, wide_table
from lexmill.session import scratch_path, stage


def _digest(id: str, seed: int = 42) -> str:
    return f"md5(concat(cast({id} as varchar), '|{seed}'))"


@query("m1_balance", f"""select doc_id, quality from labels where quality = 0 union all
select * from (select doc_id, quality from labels where quality = 1 order by {_digest('doc_id')} limit (select cast(floor(count(*) * 1.5) as bigint) from labels where quality = 0))""")
def m1_balance(spark, sf):
    return dataset.balance(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id", 1.5, minority=0, majority=1)


@query("m1_balance_events", f"""with e as (select event_id, case when event_type = 'error' then 0 else 1 end as label from events)
select event_id, label from e where label = 0 union all
select * from (select event_id, label from e where label = 1 order by {_digest('event_id')} limit (select cast(floor(count(*) * 1.5) as bigint) from e where label = 0))""")
def m1_balance_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.col("event_type") != "error").cast("int").alias("label"))
    return dataset.balance(e, "label", "event_id")


@query("m2_split", f"select doc_id, lang, case when ('0x' || left({_digest('doc_id')}, 8))::ubigint / 4294967296.0 < 0.15 then 'test' else 'train' end as part from documents")
def m2_split(spark, sf):
    return dataset.stratified_split(wide_table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id")


@query("m2_split_exact", f"""with c as (select lang, count(*) as n from documents group by lang), t as (select sum(n) as total, ceil(sum(n) * 0.15) as want from c),
q as (select lang, want * n / total as e, floor(want * n / total) as low, want from c, t),
q2 as (select lang, low + (row_number() over (order by round(e - low, 9) desc, lang) <= want - sum(low) over ())::int as quota from q),
r as (select doc_id, lang, row_number() over (partition by lang order by {_digest('doc_id')}) as rn from documents)
select doc_id, r.lang, case when rn <= quota then 'test' else 'train' end as part from r join q2 on q2.lang = r.lang""")
def m2_split_exact(spark, sf):
    return dataset.stratified_split(wide_table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", exact=True)


@query("m2_folds", f"select doc_id, quality, (row_number() over (partition by quality order by {_digest('doc_id')}) - 1) % 5 as fold from labels")
def m2_folds(spark, sf):
    return dataset.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


VOCAB = 20_000
TFIDF_SQL = f"""post as (select doc_id, term, count(*) as tf from ({grams_sql('documents', 'doc_id')}) group by all),
vocab as (select term, sum(tf)::bigint as total, count(*) as df from post group by term having count(*) >= 2 order by total desc, term limit {VOCAB}),
idf as (select term, row_number() over (order by term) - 1 as idx, df, ln((1 + (select count(*) from documents)) / (1 + df)) + 1 as idf from vocab),
w as (select doc_id, term, idx, (1 + ln(tf)) * idf as w from post join idf using (term)),
tfidf as (select doc_id, term, idx, w / sqrt(sum(w * w) over (partition by doc_id)) as weight from w)"""


def _vocabulary(spark, sf):
    docs = wide_table(spark, sf, "documents")
    postings = features.ngram_postings(docs, "doc_id", "text")
    return features.fit_vocabulary(postings, docs.select(F.count(F.lit(1))).scalar(), VOCAB)


@query("m3_vocabulary", f"with {TFIDF_SQL} select term, idx, df, round(idf, 6) as idf from idf")
def m3_vocabulary(spark, sf):
    return _vocabulary(spark, sf).withColumn("idf", F.round("idf", 6))


@query("m3_tfidf", f"with {TFIDF_SQL} select doc_id, term, idx, round(weight, 6) as weight from tfidf")
def m3_tfidf(spark, sf):
    return features.tfidf(wide_table(spark, sf, "documents"), "doc_id", "text", VOCAB).withColumn("weight", F.round("weight", 6))


@query("m4_weights", "select lang, round(sum(count(*)) over () / (count(*) over () * count(*)), 6) as weight from documents group by lang")
def m4_weights(spark, sf):
    return dataset.class_weights(wide_table(spark, sf, "documents"), "lang").withColumn("weight", F.round("weight", 6))


_PRED_SQL = "pred as (select quality as label, 1 - toxic as prediction from labels)"


def _pred(spark, sf):
    return table(spark, sf, "labels").select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))


_MATRIX_SQL = f"{_PRED_SQL}, cls as (select unnest([0, 1]) as c), matrix as (select a.c as label, b.c as prediction, (select count(*) from pred where pred.label = a.c and pred.prediction = b.c) as n from cls a, cls b)"


@query("m9_confusion", f"with {_MATRIX_SQL} select * from matrix")
def m9_confusion(spark, sf):
    return classify.confusion(_pred(spark, sf))


@query("m8_report", f"""with {_MATRIX_SQL}, s as (select c, (select sum(n) from matrix where label = c and prediction = c) as tp, (select sum(n) from matrix where label = c) as support, (select sum(n) from matrix where prediction = c) as predicted from cls),
p as (select c, support::bigint as support, coalesce(tp / nullif(predicted, 0), 0) as precision, coalesce(tp / nullif(support, 0), 0) as recall, tp from s),
f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from p),
r as (select cast(c as varchar) as class, precision, recall, f1, support from f
 union all select 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support)::bigint from f
 union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from f
 union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::bigint from f)
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r""")
def m8_report(spark, sf):
    report = classify.classification_report(classify.confusion(_pred(spark, sf)))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("m12_linear_shap", f"""with {TFIDF_SQL}, good as (select doc_id from labels where quality = 1),
n as (select count(*) as n from documents),
coef as (select term, sum(case when doc_id in (select doc_id from good) then weight else -weight end) as coef from tfidf group by term),
mean as (select term, sum(weight) / n as mean, count(*) as nnz from tfidf, n group by term, n),
ins as (select t.term, sum(abs(coef * (weight - mean))) as inside, any_value(coef) as coef, any_value(mean) as mean, any_value(nnz) as nnz from tfidf t join coef on coef.term = t.term join mean on mean.term = t.term group by t.term),
a as (select term, (inside + (n - nnz) * abs(coef * mean)) / n as attribution from ins, n)
select term, round(attribution, 6) as attribution from a order by a.attribution desc, term limit 20""")
def m12_linear_shap(spark, sf):
    """Attribution of a centroid rule: each term weighs its sum over good documents less its sum over the rest."""
    docs = wide_table(spark, sf, "documents").select("doc_id", "text")
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id", F.lit(1).alias("good")).distinct()
    # Documents meet their label before they are cut into n-grams: their weights are many more bytes.
    weights = stage(features.tfidf(docs.join(good, "doc_id", "left"), "doc_id", "text", VOCAB, keep=["good"]), "tfidf")
    sign = F.when(F.col("good") == 1, 1).otherwise(-1)
    coefs = weights.groupBy("term").agg(F.sum(sign * F.col("weight")).alias("coef"))
    top = classify.linear_attribution(weights, coefs, docs.select(F.count(F.lit(1))).scalar(), 20)
    return top.withColumn("attribution", F.round("attribution", 6))


@query("m14_require", "select count(*) >= 20 as enough from labels")
def m14_require(spark, sf):
    labels = table(spark, sf, "labels")
    dataset.require_rows(labels, 20)
    return labels.agg((F.count(F.lit(1)) >= 20).alias("enough"))


# --- Training: checked by rows and metrics, there is no SQL for it ----------------------

def article_samples(spark, sf, texts=("text", "raw_text")):
    """Balanced, labelled articles of the derived codes: doc_id, label and the named ones of text (note removed) and raw_text."""
    labelled = label_article(split_code_articles(codes(spark, sf), "code_id", "text"))
    keyed = labelled.select(F.concat_ws("#", "code_id", F.col("pos").cast("string")).alias("doc_id"), "label", *texts)
    return dataset.balance(stage(keyed, "labelled"), "label", "doc_id")


def _parts(df, text):
    """Training and held-out documents, each with its counted n-grams."""
    counted = features.count_ngrams(dataset.stratified_split(df, "label", "doc_id"), "doc_id", text, "part", ["label"])
    return [(part.docs().select("doc_id", "label"), part) for part in (counted.of("train"), counted.of("test"))]


def _parts_by_id(df, text):
    """The same where ids repeat: rows of one id are one document, whose postings move by id."""
    parts = stage(dataset.stratified_split(df, "label", "doc_id"), "parts")
    postings = stage(features.ngram_postings(parts, "doc_id", text, keep=["part"]), "postings")
    return [(parts.where(F.col("part") == p).select("doc_id", "label"), postings.where(F.col("part") == p).drop("part")) for p in ("train", "test")]


def _validity_model(spark, sf):
    train, test = _parts(article_samples(spark, sf, ["raw_text"]), "raw_text")
    return classify.fit_text_model(*train, "label", VOCAB, 2, classify.train_logreg), *test


def _report(pred):
    report = classify.classification_report(classify.confusion(pred))
    return report.withColumns({c: F.round(c, 4) for c in ("precision", "recall", "f1")})


@query("m5_logreg")
def m5_logreg(spark, sf):
    trained, test, postings = _validity_model(spark, sf)
    return _report(classify.score(trained, test, postings))


@query("m5_logreg_documents")
def m5_logreg_documents(spark, sf):
    """Quality of whole documents from their text."""
    docs = wide_table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    train, test = _parts(docs, "text")
    return _report(classify.score(classify.fit_text_model(*train, "label", VOCAB, 2, classify.train_logreg), *test))


@query("m7_cross_validation")
def m7_cross_validation(spark, sf):
    parts = dataset.stratified_split(article_samples(spark, sf, ["raw_text"]), "label", "doc_id")
    dealt = dataset.stratified_folds(parts.where(F.col("part") == "train"), "label", "doc_id")
    train = features.count_ngrams(dealt, "doc_id", "raw_text", "fold", ["label"])
    return classify.cross_validate(train.docs(), train, "label", classify.train_logreg)


@query("m10_ablation")
def m10_ablation(spark, sf):
    return classify.ablate(article_samples(spark, sf), "doc_id", "label", ["raw_text", "text"])


@query("m12_linear_shap_model")
def m12_linear_shap_model(spark, sf):
    trained, test, postings = _validity_model(spark, sf)
    return classify.linear_shap(trained, test, postings)


@query("m13_score")
def m13_score(spark, sf):
    trained, test, postings = _validity_model(spark, sf)
    return classify.in_force_only(classify.score(trained, test, postings)).select("doc_id", "label", "prediction")


@query("o5_top_features")
def o5_top_features(spark, sf):
    trained, _, _ = _validity_model(spark, sf)
    return classify.top_features(classify.coefficients(trained), 20, "coef")


@query("s13_save_model", "select true as same")
def s13_save_model(spark, sf):
    """Whether a model saved and loaded again predicts the same for every held-out row."""
    trained, test, postings = _validity_model(spark, sf)
    path = scratch_path(spark, "model")
    classify.save_model(trained.model, path)
    loaded = trained._replace(model=LogisticRegressionModel.load(path))
    before, after = (classify.score(t, test, postings).select("doc_id", F.col("prediction").alias(n)) for t, n in ((trained, "a"), (loaded, "b")))
    both = before.join(after, "doc_id", "full_outer")
    return both.agg((F.count_if(F.col("a").eqNullSafe(F.col("b"))) == F.count(F.lit(1))).alias("same"))


def _forest(spark, sf):
    """A forest that tells the languages apart; documents without one are a class of their own."""
    rows = wide_table(spark, sf, "documents").select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    langs = [r[0] for r in rows.select("lang").distinct().orderBy("lang").collect()]
    code = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1
    docs = dataset.keep_common_classes(rows.select("doc_id", "text", code.alias("label")), "label", 5)
    ids = docs.groupBy("doc_id").count()
    alone = ids.where((F.col("count") > 1) | F.col("doc_id").isNull()).isEmpty()
    train, test = (_parts if alone else _parts_by_id)(docs, "text")
    return classify.fit_text_model(*train, "label", 15_000, 2, classify.train_forest), *test


@query("m6_forest")
def m6_forest(spark, sf):
    trained, test, postings = _forest(spark, sf)
    return _report(classify.score(trained, test, postings))


@query("m11_importance")
def m11_importance(spark, sf):
    return classify.forest_importance(_forest(spark, sf)[0])
