"""Registered queries of the subpackage against their SQL, or to their last row."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lexmill.llm.queries import ORACLE, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    if name in ORACLE:
        cursor = duck.execute(ORACLE[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        expected = sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in cursor.fetchall())
        assert sorted(repr([plain(r[c]) for c in sorted(names)]) for r in rows) == expected


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()
