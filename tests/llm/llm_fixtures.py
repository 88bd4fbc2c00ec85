"""Small tables with everything an operator must bear."""

from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use themselves.
CLASH = ["id", "row", "w", "fp", "key", "text_key", "label", "group", "range", "x", "p", "n", "host", "path", "shard", "slot", "rep", "ids", "score", "v", "component", "_key"]


def odd_documents(spark, texts=()):
    """Nulls, blanks, a very long text, ties, repeated rows and clashing columns beside `texts` (id from 100 on)."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "s1", 1),
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "s1", 1),
        (2, None, None, None, None), (3, "", "en", "", 0), (4, " \n\t ", "en", "s1", 4), (None, "text without an id", "en", "s1", 3),
        (5, "long words " * 20_000, "en", "s2", 5), (6, "ÀÉ ñandú 漢字 ▁ 🙂\u0301 it's 42", "fr", "s2", 6), (7, "a\0b", "en", "s2", 3),
        *[(100 + i, t, "en", "s3", len(t)) for i, t in enumerate(texts)],
    ]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({c: F.lit("clash") for c in CLASH})


def without_rows(df):
    return df.where(F.lit(False))


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
