"""Widening of types and tables whose columns change their type."""

import itertools
import threading
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators import landing, widening
from strandline.sources import evolving

KINDS = [
    *(T.NullType(), T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()),
    *(T.DecimalType(10, 2), T.DecimalType(38, 0), T.DecimalType(38, 30), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.StringType()),
    *(T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()), T.MapType(T.StringType(), T.LongType())),
    T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DateType())]),
    T.StructType([T.StructField("b", T.TimestampType()), T.StructField("c", T.StringType())]),
]


def names(kind):
    """A type with struct fields in the order of their names."""
    if isinstance(kind, T.StructType):
        return sorted((f.name, str(names(f.dataType))) for f in kind.fields)
    return kind.simpleString()


def test_rules():
    w = widening.widest
    for a, b in itertools.product(KINDS, KINDS):
        assert names(w(a, b)) == names(w(b, a)) and w(a, a) == a
        assert names(w(w(a, b), b)) == names(w(a, b)), (a, b)  # a type that fits both is not widened again
    assert w(T.IntegerType(), T.DoubleType()) == T.DoubleType() and w(T.ShortType(), T.LongType()) == T.LongType()
    assert w(T.LongType(), T.DecimalType(10, 2)) == T.DecimalType(21, 2) and w(T.DecimalType(38, 0), T.DecimalType(38, 30)) == T.StringType()
    assert w(T.DateType(), T.TimestampType()) == T.TimestampType() and w(T.BooleanType(), T.ByteType()) == T.StringType()
    with pytest.raises(TypeError, match="binary"):
        w(T.BinaryType(), T.StringType())


def test_merge_names():
    one = T.StructType().add("a", "integer").add("B", "string")
    assert widening.merge(one, T.StructType().add("b", "string").add("A", "long").add("c", "integer")).simpleString() == "struct<a:bigint,B:string,c:int>"
    with pytest.raises(ValueError, match="collide"):
        widening.merge(one, T.StructType().add("x", "integer").add("X", "integer"))
    with pytest.raises(TypeError, match="column a"):
        widening.merge(one, T.StructType().add("a", "binary"))


def test_append_of_unlike_types(spark):
    a = spark.sql("SELECT 1 AS n, DATE'2024-01-02' AS d, named_struct('x', 1) AS s, array(1, null) AS l, null AS u")
    b = spark.sql("SELECT 2.5D AS n, TIMESTAMP'2024-01-03 04:05:06' AS d, named_struct('x', 7L, 'y', 'z') AS s, array('q') AS l, 3 AS u")
    c = spark.sql("SELECT 'many' AS N, CAST(NULL AS struct<y:string>) AS s, 5 AS extra, map('k', 1) AS l")
    out = landing.evolve_append(a, b, c)
    assert out.columns == ["n", "d", "s", "l", "u", "extra"]
    got = [tuple(r) for r in out.collect()]
    assert got == [
        ("1", datetime(2024, 1, 2), (1, None), "[1,null]", None, None),
        ("2.5", datetime(2024, 1, 3, 4, 5, 6), (7, "z"), '["q"]', 3, None),
        ("many", None, None, '{"k":1}', None, 5),
    ]


def test_a_column_changes_its_type(spark, tmp_path):
    path = f"{tmp_path}/t"
    put = lambda sql, batch: evolving.append_batch(spark.sql(sql), path, batch)
    assert put("SELECT 1 AS id, 10 AS v, null AS later", "a") == 1
    assert put("SELECT 2 AS id, 20 AS v", "b") == 1
    assert evolving.read_evolving(spark, path).schema["v"].dataType == T.IntegerType()
    assert put("SELECT 3L AS id, 0.5D AS v, CAST(1.25 AS DECIMAL(5, 2)) AS later", "c") == 2
    assert put("SELECT 4 AS id, 40 AS v", "d") == 2  # narrower than the table: stored as the table has it
    assert put("SELECT 5 AS id, 'many' AS v, 7 AS later", "e") == 3
    out = evolving.read_evolving(spark, path)
    assert out.schema.simpleString() == "struct<id:bigint,v:string,later:decimal(12,2)>"
    want = [(1, "10", None), (2, "20", None), (3, "0.5", Decimal("1.25")), (4, "40.0", None), (5, "many", Decimal("7.00"))]
    assert sorted(tuple(r) for r in out.collect()) == want


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = lambda n, kind="int": spark.range(n).select(F.col("id").cast(kind))
    evolving.append_batch(rows(5), path, 0)
    evolving.append_batch(rows(3, "string"), path, 1)  # widens the table
    evolving.append_batch(rows(4), path, 0)
    assert evolving.read_evolving(spark, path).count() == 7 and list(evolving.finished_batches(spark, path)) == [1, 2]
    with pytest.raises(ValueError, match="narrower"):
        evolving.append_batch(rows(4, "string"), path, 0)
    (tmp_path / "t" / "layout=2" / "batch=1" / "_SUCCESS").unlink()  # a batch that was never finished
    assert evolving.read_evolving(spark, path).count() == 4


def test_writers_that_meet(spark, tmp_path, monkeypatch):
    path, barrier, plain, first = f"{tmp_path}/t", threading.Barrier(3), evolving.schema_versions, threading.local()

    def together(*args):
        number = plain(*args)
        if not getattr(first, "done", False):
            first.done = True
            barrier.wait(60)
        return number

    monkeypatch.setattr(evolving, "schema_versions", together)
    frames = {"a": spark.sql("SELECT 1 AS v"), "b": spark.sql("SELECT 2.5D AS v"), "c": spark.sql("SELECT DATE'2024-05-06' AS w")}
    threads = [threading.Thread(target=evolving.append_batch, args=(df, path, name)) for name, df in frames.items()]
    [t.start() for t in threads]
    [t.join() for t in threads]
    monkeypatch.setattr(evolving, "schema_versions", plain)
    got = evolving.read_evolving(spark, path).select("v", "w").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1.0, None), (2.5, None), (None, date(2024, 5, 6))], key=str)


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no table"):
        evolving.read_evolving(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError, match="batch name"):
        evolving.append_batch(spark.range(1), f"{tmp_path}/t", "a/b")
    with pytest.raises(ValueError, match="has a type"):
        evolving.append_batch(spark.sql("SELECT null AS x"), f"{tmp_path}/t", "a")


def test_filters_reach_unchanged_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    evolving.append_batch(spark.sql("SELECT 1L AS id, 1 AS v"), path, 1)
    evolving.append_batch(spark.sql("SELECT 2L AS id, 'x' AS v"), path, 2)
    plan = evolving.read_evolving(spark, path).where("id > 1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(id,1)") == 2 and plan.count("ReadSchema: struct<id:bigint>") == 2
