"""The registered queries of the operators: names, and their SQL where they have any."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from strandline.llm import queries
from tests.conftest import SF
from tools.check import TABLES, compare


def test_each_operator_has_one_query():
    names = [m[1] for n in entry.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(map(int, names)) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert compare(queries.queries()[name](spark, SF), duck.sql(queries.oracle_sql()[name])).startswith("ok")


@pytest.mark.parametrize("name", ["op2_license_scan", "op8_secret_scan", "op10_quality_rules"])
def test_native_plans(spark, name):
    plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
