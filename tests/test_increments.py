"""The trusted zone batch by batch: several batches equal one, and a lost batch leaves nothing."""

import pytest
from pyspark.sql import functions as F

from strandline.operators import cleaning
from strandline.plans import collisions, increments

SCHEMA = "collision_id string, crash_date string, borough string, arrival int"
RECORDS = [
    ("1", "01/02/2024", "queens", 0), ("1", "01/02/2024", "queens", 0), ("2", "bad", "bronx", 0), (None, "01/02/2024", "x", 0), ("", "01/02/2024", "y", 0),
    ("1", "01/03/2024", "later", 1), ("2", "01/02/2024", "too late", 1), (None, "01/04/2024", "x", 1), ("3", "01/02/2024", None, 1), ("3", "01/02/2024", "a", 1),
    ("", "bad", "z", 2), ("4", None, "w", 2), ("3", "01/02/2024", "b", 2), ("5", "2024-01-05", "v", 2),
]


def parts(spark):
    rows = spark.createDataFrame(RECORDS, SCHEMA)
    return [rows.where(F.col("arrival") == n).withColumn("source_file", F.lit(f"part_{n}")) for n in range(3)]


def contents(df):
    return sorted(map(str, (tuple(r) for r in df.drop("batch_id").collect())))


def test_batches_equal_one(spark, tmp_path):
    batches = parts(spark)
    counts = [tuple(increments.trust_batch(b, n, f"{tmp_path}/z", order_by=["arrival"]).first()) for n, b in enumerate(batches)]
    assert counts == [(5, 3, 1, 1), (5, 1, 0, 4), (4, 1, 1, 2)]
    whole = cleaning.dedupe(batches[0].unionAll(batches[1]).unionAll(batches[2]), ["collision_id"], ["arrival"])
    kept, rejected = cleaning.split_valid(whole, cleaning.acceptable(whole))
    assert contents(increments.read_trusted(spark, f"{tmp_path}/z")) == contents(cleaning.align(cleaning.cast_records(kept), cleaning.COLLISION_SCHEMA))
    assert contents(increments.read_trusted(spark, f"{tmp_path}/z", "rejected")) == contents(rejected)
    again = increments.trust_batch(batches[0], 1, f"{tmp_path}/z")  # committed: not run again
    assert tuple(again.first()) == counts[1]


def test_a_lost_batch_leaves_nothing(spark, tmp_path, monkeypatch):
    root, batches = f"{tmp_path}/z", parts(spark)
    increments.trust_batch(batches[0], 0, root, order_by=["arrival"])
    before = contents(increments.read_trusted(spark, root))
    plain = increments.align
    monkeypatch.setattr(increments, "align", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        increments.trust_batch(batches[1], 1, root)
    monkeypatch.setattr(increments, "align", plain)
    assert contents(increments.read_trusted(spark, root)) == before and not list(tmp_path.glob("z/*/batch_id=1"))
    # a process that ended inside the batch: its rows do not count, and the next attempt takes them back
    log = increments.batch_log(spark, root)
    log.begin(1)
    batches[1].select("collision_id").write.parquet(f"{root}/keys/batch_id=1")
    assert contents(increments.read_trusted(spark, root)) == before
    assert tuple(increments.trust_batch(batches[1], 1, root, order_by=["arrival"]).first()) == (5, 1, 0, 4)


def test_only_new_files_are_cleaned(spark, tmp_path):
    lake, root, checkpoint = (f"{tmp_path}/{n}" for n in ("lake", "z", "checkpoint"))
    run = lambda: tuple(increments.trust_available(spark, lake, root, checkpoint, max_files=1).first())
    batches = parts(spark)
    batches[0].coalesce(1).write.mode("append").parquet(lake)
    assert run() == (5, 3, 1, 1)
    assert run() == (0, 0, 0, 0)
    for batch in batches[1:]:
        batch.withColumn("batch_id", F.lit(7)).coalesce(1).write.mode("append").parquet(lake)
    assert run() == (9, 2, 1, 6)
    assert increments.read_trusted(spark, root).count() == 5
    whole = collisions.trust_collisions(spark, lake, f"{tmp_path}/out", f"{tmp_path}/rejects").first()
    assert whole["total_rows"] == 14 and whole["duplicate_rows"] == 7
