"""Registered queries: names, plans, and a sample against DuckDB (tools/check.py runs them all)."""

import duckdb
import pytest

import __spark_entry__ as entry
from strandline.plans import catalog
from tests.conftest import SF
from tools.check import TABLES, compare

SAMPLE = (
    "enriched_facts", "quality_counts", "route_files", "text_file_metadata", "weather_periods", "clean_text",
    "article_fields", "article_embeddings", "clean_audio", "cosine_topk", "camera_windows_stream", "anchored_windows",
    "camera_reports", "truncate_bytes", "sorted_sink", "ivf_topk",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck.sql(entry.oracle_sql()[name])).startswith("ok")


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "avg_temperature" in rows.columns


PLAIN = ("clean_fact", "rejected_rows", "dedupe_by_key", "avg_by_group", "camera_windows", "find_duplicates", "land_new_only", "weather_periods")


@pytest.mark.parametrize("name", PLAIN)
def test_plans_have_no_cross_join_or_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["avg_by_group"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "l_returnflag" in read and "l_orderkey" not in read and "l_shipdate" not in read


def test_texts_are_hashed_once_for_their_norm(spark):
    rows = entry.queries()["hash_embedding_norm"](spark, SF)
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
