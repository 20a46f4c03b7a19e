"""Every registered query against its SQL on the smallest tables, and the plans that matter."""

import duckdb
import pytest
from helpers import plan

import __spark_entry__ as entry_points
from wireloom.plans.oracle import ORACLES
from wireloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = set()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in ("documents", "pages", "events", "orders"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def by_name(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in places], sorted((tuple(row[i] for i in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    got = by_name(frame.columns, [tuple(row) for row in frame.collect()])
    assert got[1]
    if name in ROWS_ONLY:
        return
    result = con.execute(ORACLES[name])
    assert got == by_name([column[0] for column in result.description], result.fetchall())


def test_every_query_but_the_listed_has_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and set(ORACLES) <= set(QUERIES)


def test_classifier_learns(spark):
    got = QUERIES["classify_text"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    right, total = got.join(docs, "doc_id").selectExpr("count_if(category = lang)", "count(*)").first()
    assert right / total > 0.95


def test_registered_queries_hold_these():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["clean_text", "strip_fixed_boilerplate", "validate_final", "headline", "html_text", "parse_message_regular", "last_news_id"]
)
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    # Character references have names like ``DownArrow``, so the operators' whole names are sought.
    assert not any(operator in text for operator in ("Python", "ArrowEval", "MapInArrow", "MapInPandas", "InArrow", "InPandas"))


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["articles_by_agency"](spark, FOLDER))
    assert "text:string" not in text
    assert "text:string" not in plan(QUERIES["known_ids"](spark, FOLDER))


def test_missing_summaries_are_found_by_the_scan(spark):
    assert "PushedFilters: [Or(" in plan(QUERIES["anniversary_missing"](spark, FOLDER)).replace("IsNotNull(o_orderdate), ", "")


def test_facts_are_not_shuffled_for_small_lookups(spark):
    text = plan(QUERIES["category_override"](spark, FOLDER))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
