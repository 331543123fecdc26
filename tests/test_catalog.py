"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from voxloom.checks.catalog import ORACLES, QUERIES

FOLDER = entry.SMOKE_DIR
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROWS_ONLY = {"t11_segment_latin"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    got = QUERIES[name](spark, FOLDER)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "REPARTITION_BY_NUM" not in plan
    want = con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    order = [names.index(c) for c in got.columns]
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_entry(spark):
    report = entry.entry(spark)
    assert report.count() == 4
    assert report.filter("is_best_cor").count() == report.filter("is_best_wer").count() == 1
