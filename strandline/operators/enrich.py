"""Exploitation-zone aggregation and enrichment joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The averaged weather columns.
WEATHER_MEASURES = ("temperature", "wind_speed_mph", "dewpoint_celsius", "precip_prob", "humidity")

# A side is broadcast up to these sizes, both checked.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Keys above this share of the fact count as hot; at most 1/HOT_SHARE of them can exist.
HOT_SHARE = 0.001


def mean_by(df: DataFrame, key: str, measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    """``avg_<c>`` of the measures that exist, nulls ignored, one row per key.

    Sums and counts of non-null values, which combine on the map side; a key without any value has null.
    """
    present = {c: f"avg_{c}" for c in dict.fromkeys(measures) if c in set(df.columns)}
    if not present:
        return df.select(key).distinct()
    return df.groupBy(key).agg({c: "mean" for c in present}).withColumnsRenamed({f"avg({c})": a for c, a in present.items()}).select(key, *present.values())


def _has_key(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string") != "", F.lit(False))


def drop_blank_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither null nor empty."""
    return df.filter(_has_key(key))


def _row_bytes(df: DataFrame) -> Column:
    """Rough width of a row: text and binary by length, arrays and maps as JSON, the rest 8 bytes."""
    width = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(c)))
        else:
            size = F.lit(8)
        width = width + F.coalesce(size, F.lit(0))
    return width.cast("bigint")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within both limits, reading no further than the row limit."""
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    return seen["n"] <= max_rows and seen["b"] <= max_bytes


def enrich(fact: DataFrame, dim: DataFrame, key: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a dimension with one row per key, dropping facts without a key.

    A dimension of checked size is broadcast, so the fact is not shuffled. A
    larger one goes through :func:`skew_left_join`.
    """
    fact = drop_blank_key(fact, key)
    dim = dim.persist()
    if fits_broadcast(dim, max_rows):
        return fact.join(F.broadcast(dim), key, "left")
    return skew_left_join(fact, dim, key)


def skew_left_join(fact: DataFrame, dim: DataFrame, key: str, hot_share: float = HOT_SHARE) -> DataFrame:
    """Left join that keeps hot fact keys out of the shuffle.

    Keys holding more than ``hot_share`` of the fact are found with one
    map-side-combined count; there are at most ``1/hot_share`` of them, so their
    dimension rows (one per key) can always be broadcast. All other keys take an
    ordinary shuffle join.
    """
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).persist()
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    hot = [r[0] for r in counts.filter(F.col("__n") > total * hot_share).select(key).collect()]
    counts.unpersist()
    if not hot:
        return fact.join(dim, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    hot_rows = fact.filter(is_hot).join(F.broadcast(dim.filter(is_hot)), key, "left")
    return hot_rows.unionByName(fact.filter(~is_hot).join(dim, key, "left"))


def match_counts(joined: DataFrame, probe: str = "avg_temperature") -> DataFrame:
    """One row: joined, matched and unmatched rows; without the probe column nothing matched."""
    hit = F.col(probe).isNotNull() if probe in joined.columns else F.lit(False)
    return joined.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(hit).alias("matched_rows"),
        F.count_if(~hit).alias("unmatched_rows"),
    )


def blank_key_counts(fact: DataFrame, key: str) -> DataFrame:
    """Rows kept and dropped by :func:`drop_blank_key` (null keys drop too)."""
    kept = _has_key(key)
    return fact.agg(F.count_if(kept).alias("kept_rows"), F.count_if(~kept).alias("dropped_rows"))


def restamp(df: DataFrame, column: str = "exploited_at", stale: Sequence[str] = ("trusted_at", "exploited_at")) -> DataFrame:
    """Replace earlier load timestamps with the current one."""
    return df.drop(*stale).withColumn(column, F.current_timestamp())


def top_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), F.col(column).asc_nulls_last()).limit(n)
