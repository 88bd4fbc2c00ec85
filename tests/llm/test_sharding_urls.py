import random
import re
from collections import Counter

import pytest
from llm_fixtures import odd_documents, without_rows
from pyspark.sql import functions as F

from lexmill.llm import sharding, urlfilter
from lexmill.llm.urlfilter import Rule


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 1000, 4097])
def test_permutation_is_a_bijection(spark, n):
    got = spark.range(n).select(sharding.permuted(F.col("id"), n, 7).alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(n))


def test_permutation_needs_no_data(spark):
    n = 10**12
    got = [r["p"] for r in spark.range(1000).select(sharding.permuted(F.col("id") * 10**9, n, 7).alias("p")).collect()]
    assert len(set(got)) == 1000 and min(got) >= 0 and max(got) < n


def test_shards_are_even_and_gapless(spark):
    df = odd_documents(spark).select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    rows = sharding.assign_shards(df.union(df), ["doc_id", "size"], 4, 1).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == 18 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    again = sharding.assign_shards(df.union(df).repartition(3), ["doc_id", "size"], 4, 1).collect()
    assert Counter((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in again) == Counter((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in rows)
    assert sharding.assign_shards(without_rows(df), ["doc_id", "size"], 4, 1).count() == 0


def brute(rule, host, path):
    part = lambda glob: "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob)
    return re.fullmatch(part(rule.host), host, re.S) is not None and re.fullmatch(part(rule.path), path, re.S) is not None


def test_automaton_equals_regular_expressions():
    rng = random.Random(3)
    glob = lambda k: "".join(rng.choice("ab.*?/") for _ in range(rng.randint(0, k)))
    rules = [Rule(str(i), glob(6), glob(30), "block") for i in range(40)]  # patterns cross word borders
    urls = [("".join(rng.choice("ab.") for _ in range(rng.randint(0, 6))), "".join(rng.choice("ab./") for _ in range(rng.randint(0, 20)))) for _ in range(400)]
    found = urlfilter.ShiftAnd(rules).matches([h.encode() for h, _ in urls], [p.encode() for _, p in urls])
    assert urlfilter.ShiftAnd(rules).words > 5
    for row, (host, path) in zip(found, urls):
        assert row.tolist() == [brute(r, host, path) for r in rules]


def test_urls_at_the_edges(spark):
    long = "http://a.org/" + "x" * 50_000
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?q", "x://example.org", "x://example.org?/es/", "http://evil.com/b.example.org/es/", "http://org/", long,
            "http://b.com/de/", "http://com/fr/x#y", "http://ü.org/é", "http://ads.net/x", "http://h.net/a/login", "http://example.org/en/1"]
    df = spark.createDataFrame([(i, u, "z", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, extra int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(df, "url", urlfilter.RULES, urlfilter.DEFAULTS).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "block")
    assert got[4] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[5] == ("example.org", "", None, "allow") and got[6] == ("example.org", "", None, "allow")
    assert got[7] == ("evil.com", "/b.example.org/es/", None, "allow") and got[8][2:] == ("org/", "allow")
    assert got[9][2:] == ("org/", "allow") and len(got[9][1]) == 50_001
    assert got[10][2:] == ("com/de/", "block") and got[11][1:] == ("/fr/x", "com/fr/", "allow") and got[12][2:] == ("org/", "allow")
    assert got[13][2:] == (None, "block") and got[14][2:] == (None, "block") and got[15][2:] == ("example.org/en/1", "block")
    assert urlfilter.judge_urls(without_rows(df), "url", urlfilter.RULES).count() == 0
