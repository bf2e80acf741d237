"""Global row numbers without one sorted task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, group: str, keys: list[str], stage, parts: int | None = None, name: str = "rank") -> DataFrame:
    """``df`` plus the 0-based place of each row in its ``group``, by ``keys`` and then by the order of input.

    Rows are dealt by range over (group, keys, input order), so that no key, however frequent, meets in one
    task; the table is written once by ``stage`` and numbered within each partition; the offset of a
    (partition, group) is the count of the group in earlier partitions, a table of one row per such pair.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(group), *(F.col(k) for k in keys), F.col("_uid")]
    dealt = df.withColumn("_uid", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    dealt = stage(dealt.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part", F.col(group).alias("_group")).agg(F.count("*").alias("_n"), F.min("_uid").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    here = Window.partitionBy("_part", group).orderBy(*order[1:])
    out = dealt.withColumn("_i", F.row_number().over(here) - 1)
    same = (out["_part"] == counts["_part"]) & out[group].eqNullSafe(counts["_group"])
    out = out.join(counts, same).withColumn(name, F.col("_offset") + F.col("_i"))
    return out.select(*df.columns, name)
