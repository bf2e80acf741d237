"""Serving-table operations: counts, previews, duplicate keys, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.cleaning import dedupe


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def preview(df: DataFrame, n: int = 100, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """The first ``n`` rows; give ``order_by`` for a reproducible choice."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once, most frequent first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
    return counts.orderBy(F.desc("cnt"), key)


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the one with the highest version."""
    return dedupe(df, [key], [F.desc_nulls_last(version)])


def upsert_latest(stored: DataFrame, incoming: DataFrame, key: str, version: str) -> DataFrame:
    """Stored and incoming rows merged, newest version per key."""
    return latest_per_key(stored.unionByName(incoming, allowMissingColumns=True), key, version)


def replace_on_dimension_change(stored: DataFrame, dim: int, vector: str = "embedding") -> bool:
    """Whether stored vectors have another length than ``dim`` and must be replaced."""
    return not stored.filter(F.size(vector) != dim).isEmpty()
