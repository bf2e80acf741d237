"""Trusted-zone cleaning of all-string records: dedupe, accept/reject, casts, counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.columns import (
    as_col,
    in_unsigned_range,
    normalize_name,
    parse_date,
    safe_double,
    safe_int,
    safe_long,
)

# The collision record, in output order.
COUNT_COLUMNS = tuple(
    f"number_of_{who}_{what}"
    for who in ("persons", "pedestrians", "cyclist", "motorist")
    for what in ("injured", "killed")
)
NAME_COLUMNS = ("borough", "on_street_name", "cross_street_name", "off_street_name")
COLLISION_SCHEMA = T.StructType(
    [T.StructField("crash_date", T.DateType()), T.StructField("crash_time", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("borough", "zip_code")]
    + [T.StructField(c, T.DoubleType()) for c in ("latitude", "longitude")]
    + [T.StructField(c, T.StringType()) for c in NAME_COLUMNS[1:]]
    + [T.StructField(c, T.IntegerType()) for c in COUNT_COLUMNS]
    + [T.StructField(f"contributing_factor_vehicle_{i}", T.StringType()) for i in range(1, 6)]
    + [T.StructField("collision_id", T.LongType())]
    + [T.StructField(f"vehicle_type_code_{i}", T.StringType()) for i in range(1, 6)]
    + [T.StructField("source_file", T.StringType())]
)


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key; ties fall to ``order_by``, then to every other column.

    ``row_number() = 1`` lets Spark put a group limit before the shuffle, so a
    key (or null) that holds a third of all rows sends one row per input
    partition instead of all of them.
    """
    order = [as_col(c) for c in (order_by or [])]
    named = set(keys) | {c for c in (order_by or []) if isinstance(c, str)}
    sortable = [f.name for f in df.schema.fields if f.name not in named and not isinstance(f.dataType, T.MapType)]
    order += [F.col(f"`{c}`").asc_nulls_first() for c in sortable]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def split_valid(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; a null predicate counts as rejected."""
    ok = F.coalesce(predicate, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def has_valid_date(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNotNull() & (F.trim(c) != "") & parse_date(c).isNotNull()


def align(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Project to ``schema``; absent columns and null strings take their default.

    Without an entry in ``defaults`` numbers default to 0 and strings to "" when
    the column is absent; nulls in existing non-string columns stay null.
    """
    defaults = dict(defaults or {})
    present = set(df.columns)
    out = []
    for f in schema.fields:
        fallback = "" if isinstance(f.dataType, T.StringType) else None
        if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.FractionalType):
            fallback = 0
        fallback = F.lit(defaults.get(f.name, fallback)).cast(f.dataType)
        if f.name not in present:
            out.append(fallback.alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(F.col(f.name).cast("string"), fallback).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def cast_records(
    df: DataFrame,
    dates: Iterable[str] = ("crash_date",),
    doubles: Iterable[str] = ("latitude", "longitude"),
    ints: Iterable[str] = COUNT_COLUMNS,
    longs: Iterable[str] = ("collision_id",),
    names: Iterable[str] = NAME_COLUMNS,
) -> DataFrame:
    """Typed columns in one projection: bad numbers take 0, bad coordinates null."""
    rules: dict[str, Column] = {}
    for group, rule in ((dates, parse_date), (doubles, safe_double), (ints, safe_int), (longs, safe_long), (names, normalize_name)):
        rules.update({c: rule(c) for c in group if c in df.columns})
    return df.select(*[rules.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def acceptable(df: DataFrame, date: str = "crash_date") -> Column:
    """The stage's rule for a record: a date that parses, and counts and id within their unsigned targets."""
    return has_valid_date(date) & fits_target(df)


def clean_collisions(
    df: DataFrame,
    key: str = "collision_id",
    date: str = "crash_date",
    order_by: Sequence[Column | str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Deduplicate, split on the date and return (typed accepted rows, raw rejected rows).

    Values outside their unsigned targets are kept as they are; :func:`acceptable` is the stage's rule.
    """
    accepted, rejected = split_valid(dedupe(df, [key], order_by), has_valid_date(date))
    return align(cast_records(accepted), COLLISION_SCHEMA), rejected


def clean_counts(
    df: DataFrame,
    key: str = "collision_id",
    date: str = "crash_date",
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """One row: total, clean, duplicates, rejected, dropped.

    The raw side contributes only a row count, so the union costs one extra
    scan of no columns rather than a join of two one-row results.
    """
    zero = F.lit(0).cast("bigint")
    ok = F.coalesce(has_valid_date(date), F.lit(False)).cast("bigint")
    raw = df.select(F.lit(1).cast("bigint").alias("total"), zero.alias("kept"), zero.alias("clean"))
    kept = dedupe(df, [key], order_by).select(zero.alias("total"), F.lit(1).cast("bigint").alias("kept"), ok.alias("clean"))
    sums = raw.unionAll(kept).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("total", "kept", "clean")])
    return sums.select(
        F.col("total").alias("total_rows"),
        F.col("clean").alias("clean_rows"),
        (F.col("total") - F.col("kept")).alias("duplicate_rows"),
        (F.col("kept") - F.col("clean")).alias("rejected_rows"),
        (F.col("total") - F.col("clean")).alias("dropped_rows"),
    )


def unsigned_fit(
    df: DataFrame, uint16: Iterable[str] = COUNT_COLUMNS, uint32: Iterable[str] = ("collision_id",)
) -> Column:
    """True where every count fits its unsigned target; use with :func:`split_valid`."""
    ok = F.lit(True)
    for bits, names in ((16, uint16), (32, uint32)):
        for c in names:
            if c in df.columns:
                ok = ok & in_unsigned_range(c, bits)
    return ok


def fits_target(df: DataFrame) -> Column:
    """:func:`unsigned_fit` for all-string records, on the values they will be cast to."""
    ok = F.lit(True)
    for bits, rule, names in ((16, safe_int, COUNT_COLUMNS), (32, safe_long, ("collision_id",))):
        for c in names:
            if c in df.columns:
                ok = ok & in_unsigned_range(rule(c), bits)
    return ok


def reason_counts(df: DataFrame, reason: str = "error") -> DataFrame:
    """Rows per reason; accepted rows (no reason) count under ``accepted``."""
    label = F.coalesce(F.col(reason), F.lit("accepted"))
    return df.groupBy(label.alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))
