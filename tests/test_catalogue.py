"""Every registered query against its SQL text, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare  # noqa: E402
from corvane import catalogue  # noqa: E402

DATA, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
OUT_OF_PLACE = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"]


@pytest.fixture(scope="module")
def duck():
    connections = {}
    for folder in (DATA, LARGER):
        con = connections[folder] = duckdb.connect()
        for file in sorted(os.listdir(folder)):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{file}'")
    return connections


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, plan_of, name):
    df = QUERIES[name](spark, DATA)
    plan = plan_of(df)
    assert not [step for step in OUT_OF_PLACE if step in plan], plan
    outcome, _ = compare(spark, duck[DATA], DATA, name, lambda *_: df, SQL.get(name))
    if outcome == "EMPTY":  # too few rows there; the larger tables have some
        outcome, _ = compare(spark, duck[LARGER], LARGER, name, QUERIES[name], SQL.get(name))
    assert outcome.startswith("ok"), outcome
    assert "types" not in outcome, outcome


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["year_post", "post_type", "number_likes", "number_comments"]
    assert df.count() > 0
