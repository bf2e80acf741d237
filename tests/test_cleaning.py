from datetime import date

import pytest
from pyspark.sql import functions as F

from strandline.operators import cleaning, enrich, tables
from strandline.plans import collisions


def records(spark):
    rows = [
        ("1", "01/02/2024", " queens ", "40.7", "1.0", "b.csv"),
        ("1", "2024-01-02", "BRONX", "x", "2", "a.csv"),
        (None, "2024-01-02T00:00:00.000", None, None, "x", "c.csv"),
        (None, "2024-01-03", "", "1", "5", "d.csv"),
        ("3", "1/2/2024", "bronx", "1", "5", "e.csv"),
        ("4", " ", "bronx", "1", "5", "f.csv"),
        ("5.0", "2024-01-05", "bronx", "1", "70000", "g.csv"),
    ]
    return spark.createDataFrame(
        rows, "collision_id string, crash_date string, borough string, latitude string, number_of_persons_injured string, source_file string"
    )


def test_clean_collisions(spark):
    clean, rejected = cleaning.clean_collisions(records(spark), order_by=["source_file"])
    assert clean.columns == cleaning.COLLISION_SCHEMA.names and len(clean.columns) == 29
    rows = {r["source_file"]: r for r in clean.collect()}
    assert set(rows) == {"a.csv", "c.csv", "g.csv"}
    a, c, g = rows["a.csv"], rows["c.csv"], rows["g.csv"]
    assert (a["crash_date"], a["borough"], a["latitude"], a["number_of_persons_injured"]) == (date(2024, 1, 2), "BRONX", None, 2)
    assert (c["collision_id"], c["borough"], c["number_of_persons_injured"], c["crash_time"]) == (0, "", 0, "")
    assert g["collision_id"] == 5 and g["number_of_motorist_killed"] == 0
    assert {r["source_file"] for r in rejected.collect()} == {"e.csv", "f.csv"}


def test_counts_separate_duplicates_from_rejects(spark):
    row = cleaning.clean_counts(records(spark), order_by=["source_file"]).first().asDict()
    assert row == {"total_rows": 7, "clean_rows": 3, "duplicate_rows": 2, "rejected_rows": 2, "dropped_rows": 4}


def test_dedupe_is_deterministic_for_any_partitioning(spark):
    rows = [(k % 5 if k % 3 else None, k * 7 % 11, f"v{k}") for k in range(300)]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    seen = {tuple(sorted(map(str, cleaning.dedupe(df.repartition(n), ["k"]).collect()))) for n in (1, 3, 8)}
    assert len(seen) == 1 and len(next(iter(seen))) == 6


def test_dedupe_limits_hot_keys_before_the_shuffle(spark, table):
    plan = cleaning.dedupe(table("lineitem"), ["l_orderkey"])._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("Exchange hashpartitioning"), plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2 and before < after


def test_unsigned_range(spark):
    df = spark.createDataFrame([(-1,), (0,), (65535,), (65536,), (None,)], "number_of_persons_killed int")
    got = [r[0] for r in df.select(cleaning.unsigned_fit(df)).collect()]
    assert got == [False, True, True, False, False]


def fact_and_dim(spark):
    fact = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 40}") for i in range(600)] + [(-1, ""), (-2, None)], "id int, k string")
    dim = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 40, 2)], "k string, avg_temperature double")
    return fact, dim


@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_enrich_keeps_rows_on_both_paths(spark, max_rows):
    fact, dim = fact_and_dim(spark)
    out = enrich.enrich(fact, dim, "k", max_rows=max_rows)
    lookup = {r["k"]: r["avg_temperature"] for r in dim.collect()}
    got = sorted((r["id"], r["avg_temperature"]) for r in out.collect())
    assert got == sorted((r["id"], lookup.get(r["k"])) for r in fact.collect() if r["k"])
    counts = enrich.match_counts(out).first()
    assert counts["total_rows"] == 600 and counts["matched_rows"] + counts["unmatched_rows"] == 600


def test_mean_includes_zeros_and_skips_nulls(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 4.0), ("a", None), ("b", None)], "k string, temperature double")
    assert {r["k"]: r["avg_temperature"] for r in enrich.mean_by(df, "k").collect()} == {"a": 2.0, "b": None}


def test_blank_key_counts(spark):
    fact, _ = fact_and_dim(spark)
    assert enrich.blank_key_counts(fact, "k").first() == (600, 2)


def test_top_counts_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacd"], "v string")
    assert [tuple(r) for r in enrich.top_counts(df, "v", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_restamp(spark):
    df = spark.createDataFrame([(1, "old")], "id int, trusted_at string")
    assert enrich.restamp(df).columns == ["id", "exploited_at"]


def test_upsert_takes_the_newest(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "f string, v int, s string")
    new = spark.createDataFrame([("b", 2, "y"), ("c", 1, "z")], "f string, v int, s string")
    assert sorted(map(tuple, tables.upsert_latest(old, new, "f", "v").collect())) == [("a", 1, "x"), ("b", 2, "y"), ("c", 1, "z")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, 3, 3)], "k int")
    assert [tuple(r) for r in tables.duplicate_keys(df, "k").collect()] == [(3, 3), (1, 2)]


def test_structured_flow(spark, tmp_path):
    csv = tmp_path / "csv"
    csv.mkdir()
    (csv / "p1.csv").write_text(
        "Collision ID,CRASH DATE,Borough,NUMBER OF PERSONS INJURED\n1,01/02/2024,queens,1\n1,01/02/2024,queens,1\n2,bad,bronx,0\n"
    )
    (csv / "empty.csv").write_text("Collision ID,CRASH DATE,Borough,NUMBER OF PERSONS INJURED\n")
    paths = {n: str(tmp_path / n) for n in ("lake", "clean", "rejects", "weather", "final")}
    collisions.land_csv(spark, str(csv), paths["lake"])
    counts = collisions.trust_collisions(spark, paths["lake"], paths["clean"], paths["rejects"]).first().asDict()
    assert counts == {"total_rows": 3, "clean_rows": 1, "rejected_rows": 1, "duplicate_rows": 1}
    rejected = spark.read.option("header", True).option("recursiveFileLookup", True).csv(paths["rejects"]).collect()
    assert [r["crash_date"] for r in rejected] == ["bad"]
    weather = spark.createDataFrame([("QUEENS", 10.0), ("QUEENS", 20.0)], "borough string, temperature double")
    weather.write.parquet(paths["weather"])
    assert tuple(collisions.exploit_collisions(spark, paths["clean"], paths["weather"], paths["final"]).first()) == (1, 1, 0)
    row = spark.read.parquet(paths["final"]).first()
    assert row["avg_temperature"] == 15.0 and "trusted_at" not in row.asDict() and row["exploited_at"]


def test_no_shuffle_of_the_fact_for_a_small_dimension(spark, table):
    dim = table("orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("avg_temperature"))
    fact = table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("n"))
    plan = enrich.enrich(fact, dim, "o_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
