"""Membership filter: no key is lost, few others pass, and the asked table does not move."""

import pytest

from strandline.operators.membership import key_filter, might_hold, not_yet_in


@pytest.mark.parametrize("blocks", [1, 7, 2048])
def test_members_pass_and_few_others(spark, blocks):
    keys = spark.range(0, 40_000, 40).selectExpr("concat('k', id) AS k", "id % 3 AS g")
    table = spark.range(20_000).selectExpr("concat('k', id) AS k", "id % 3 AS g", "id AS other")
    kept = might_hold(table, ["k", "g"], key_filter(keys, ["k", "g"], blocks), blocks)
    assert kept.columns == ["k", "g", "other"]
    got = {r["other"] for r in kept.collect()}
    assert set(range(0, 20_000, 40)) <= got and len(got) < 500 + 400


def test_an_overfull_filter_loses_nothing(spark):
    keys, table = spark.range(200_000), spark.range(0, 300_000, 1000)
    assert {r[0] for r in might_hold(table, ["id"], key_filter(keys, ["id"], 1), 1).collect()} >= set(range(0, 200_000, 1000))
    rows = spark.range(150_000, 250_000, 500)
    assert {r[0] for r in not_yet_in(rows, spark.range(200_000), ["id"], 1).collect()} == set(range(200_000, 250_000, 500))


def test_empty_sides_and_nulls(spark):
    none = spark.createDataFrame([], "k string")
    some = spark.createDataFrame([("a",), (None,), ("",), ("a",)], "k string")
    assert might_hold(some, ["k"], key_filter(none, ["k"])).count() == 0
    assert might_hold(none, ["k"], key_filter(some, ["k"])).count() == 0
    assert not_yet_in(some, none, ["k"]).count() == 4 and not_yet_in(none, some, ["k"]).count() == 0
    seen = spark.createDataFrame([(None,), ("b",)], "k string")
    assert sorted(r["k"] for r in not_yet_in(some, seen, ["k"]).collect()) == ["", "a", "a"]


def test_the_asked_table_is_not_shuffled(spark, tmp_path):
    spark.range(50_000).selectExpr("concat('k', id) AS k").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    kept = might_hold(table, ["k"], key_filter(spark.range(10).selectExpr("concat('k', id) AS k"), ["k"]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(__block" in plan  # the filter's own
    assert "BroadcastHashJoin" in plan and "Python" not in plan
