"""Structured flow: CSV parts to the clean table, forecasts to the enriched table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.cleaning import (
    COLLISION_SCHEMA,
    acceptable,
    align,
    cast_records,
    clean_collisions,
    dedupe,
)
from strandline.operators.enrich import enrich, match_counts, mean_by, restamp
from strandline.session import scratch_path
from strandline.sources.readers import read_csv_strings, read_split, read_table
from strandline.sources.writers import write_documents, write_rejects, write_sorted, write_split

SORT_KEYS = ("crash_date", "collision_id", "source_file")


def land_csv(spark: SparkSession, source: str, table: str, limit: int | None = None) -> None:
    """Append CSV parts to the all-string lake table."""
    write_documents(read_csv_strings(spark, source, limit=limit), table)


def enrich_collisions(
    records: DataFrame, weather: DataFrame, key: str = "borough", order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """Clean all-string records and join the per-borough weather averages."""
    clean, _ = clean_collisions(records, order_by=order_by)
    return enrich(clean, mean_by(weather, key), key)


def trust_collisions(spark: SparkSession, table: str, out: str, rejects: str) -> DataFrame:
    """Clean the lake table into ``out`` and save what was rejected; returns the counts.

    The deduplicated rows are written once, split by validity, so the accepted and
    rejected branches never repeat the shuffle. Values that do not fit their
    unsigned target are rejected as well instead of wrapping.
    """
    raw = read_table(spark, table)
    staged = scratch_path(spark, "trusted")
    unique = dedupe(raw, ["collision_id"])
    write_split(unique, acceptable(unique), staged)
    kept, rejected = read_split(spark, staged)
    accepted = align(cast_records(kept), COLLISION_SCHEMA)
    write_sorted(accepted.withColumn("trusted_at", F.current_timestamp()), out, SORT_KEYS)
    write_rejects(rejected, rejects)
    # Three row counts from file footers.
    total, clean, bad = raw.count(), kept.count(), rejected.count()
    row = [(total, clean, bad, total - clean - bad)]
    return spark.createDataFrame(row, "total_rows bigint, clean_rows bigint, rejected_rows bigint, duplicate_rows bigint")


def exploit_collisions(spark: SparkSession, collisions: str, weather: str, out: str) -> DataFrame:
    """Join the trusted table with weather averages into ``out``; returns the match counts."""
    facts = restamp(spark.read.parquet(collisions))
    joined = enrich(facts, mean_by(read_table(spark, weather), "borough"), "borough")
    write_sorted(joined, out, SORT_KEYS)
    return match_counts(spark.read.parquet(out))
