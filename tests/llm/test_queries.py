"""The registered queries on the smallest tables, next to their SQL texts or plain versions."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare  # noqa: E402
from corvane.llm import queries  # noqa: E402
from test_near_dedup import brute_force  # noqa: E402
from test_secret_scan import base  # noqa: E402

DATA = "/root/testdata/sf0.001"
NAMES = sorted(queries.queries(), key=lambda name: int(name[2:].split("_")[0]))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return con


def texts(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()


def test_all_ten_are_registered():
    assert [int(name[2:].split("_")[0]) for name in NAMES] == list(range(1, 11))
    assert {*NAMES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    outcome, _ = compare(spark, duck, DATA, name, queries.queries()[name], queries.oracle_sql()[name])
    assert outcome.startswith("ok") and "types" not in outcome, outcome


@pytest.mark.parametrize("name", [name for name in NAMES if name[:4] in ("op3_", "op4_", "op9_") or name[:5] == "op10_"])
def test_native_queries_run_no_python(spark, plan_of, name):
    assert not [step for step in ("Python", "Pandas", "Arrow") if step in plan_of(queries.queries()[name](spark, DATA))]


def test_near_duplicates_against_all_pairs(spark, duck, values):
    assert values(queries.op2_near_dedup(spark, DATA)) == brute_force(texts(duck), 4, 80)


def test_secrets_against_plain_search(spark, duck):
    found = {row.doc_id: row for row in queries.op3_secret_scan(spark, DATA).collect()}
    for doc, text in texts(duck):
        counts = {kind: len(spans) for kind, spans in base(text).items()}
        assert {kind: found[doc][f"n_{kind}"] for kind in counts} == counts


def test_leaks_against_whole_items(spark, duck):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    held = {(doc, item) for doc, text in texts(duck) for item, own in items if own in text}
    found = {(row.doc_id, row.item_id) for row in queries.op1_decontaminate(spark, DATA).collect()}
    assert held <= found and len(found - held) <= 1


def test_main_text_of_articles(spark, duck):
    found = {row.page_id: row for row in queries.op8_html_text(spark, DATA).collect()}
    for page, html in duck.execute("SELECT page_id, html FROM pages").fetchall():
        assert found[page].n_chars == len(found[page].text) > 0
        assert not {"<", "©"} & set(found[page].text) or "&lt;" in html


def test_lines_of_every_document(spark, duck):
    rows = queries.op6_line_dedup(spark, DATA).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert {row.doc_id: row.n for row in rows} == {doc: text.count("\n") + 1 for doc, text in texts(duck)}
