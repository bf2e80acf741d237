"""Nested JSON documents to flat rows: weather forecasts, camera reports, annotations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.columns import CAMERA_RULES, LOCATION_RULES, as_col, first_int, rule_map, safe_double

# The labels kept as columns of the camera table.
CAMERA_LABELS = ("MotorBike", "Pedestrian", "Bike", "LMV", "Auto", "LCV", "e-Rickshaw")

# Loosely typed fields are read as text, so a scalar where an object is
# expected costs that field only and not the whole document.
WEATHER_SCHEMA = """
    metadata struct<
        location: struct<name: string, lat: string, lon: string>,
        grid: struct<office: string, grid_x: string, grid_y: string>,
        endpoint: string, requested_at_utc: string, source_url: string>,
    data struct<
        geometry: struct<type: string>,
        properties: struct<
            generatedAt: string, updateTime: string, validTimes: string, units: string,
            periods: array<struct<
                startTime: string, temperature: string, isDaytime: string, windSpeed: string,
                dewpoint: string, probabilityOfPrecipitation: string, relativeHumidity: string,
                shortForecast: string>>>>,
    _corrupt_record string
"""
REPORT_SCHEMA = """
    camera_id string, date string, avg_per_frame map<string, string>,
    total_frames_processed string, _corrupt_record string
"""


def parse_documents(df: DataFrame, schema: str, content: str = "content", out: str = "doc") -> DataFrame:
    """Add the parsed struct and ``error`` (``invalid_json`` or null) to a text column."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json(F.col(content), schema, options)
    broken = F.col(out).isNull() | F.col(f"{out}._corrupt_record").isNotNull()
    return df.withColumn(out, parsed).withColumn("error", F.when(broken, F.lit("invalid_json")))


def nested_value(c: Column) -> Column:
    """``value`` of a JSON object given as text; null for a missing or scalar field."""
    return F.get_json_object(c, "$.value")


def explode_periods(df: DataFrame, doc: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """One raw row per forecast period with the location name and guarded values."""
    # The outer form plus a filter: for a plain explode the optimizer adds a
    # non-empty check below it, which would parse every document twice.
    # A document with an error is skipped whole: what could be parsed of it is no row. (A filter on the
    # error would be pushed below the parsing and repeat it.)
    periods = F.col(f"{doc}.data.properties.periods")
    if "error" in df.columns:
        periods = F.when(F.col("error").isNull(), periods)
    rows = df.select(
        *keep,
        F.coalesce(F.col(f"{doc}.metadata.location.name"), F.lit("")).alias("raw_location"),
        F.explode_outer(periods).alias("p"),
    ).filter("p is not null")
    text = lambda name: F.coalesce(F.col(f"p.{name}"), F.lit(""))
    whole = lambda name: F.coalesce(
        nested_value(F.col(f"p.{name}")).try_cast("double").try_cast("int"), F.lit(0)
    )
    return rows.select(
        *keep,
        "raw_location",
        text("startTime").alias("start_time"),
        text("temperature").alias("temperature_raw"),
        F.coalesce(F.col("p.isDaytime").try_cast("boolean"), F.lit(False)).alias("is_daytime"),
        text("windSpeed").alias("wind_speed_raw"),
        safe_double(nested_value(F.col("p.dewpoint")), 0.0).alias("dewpoint_raw"),
        whole("probabilityOfPrecipitation").alias("precip_prob_raw"),
        whole("relativeHumidity").alias("humidity_raw"),
        text("shortForecast").alias("weather_description"),
    )


def weather_rows(
    periods: DataFrame, rules: Iterable[tuple[str, str]] = LOCATION_RULES, signed: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed weather record of each raw period; temperatures lose their sign unless ``signed``."""
    return periods.select(
        *keep,
        rule_map("raw_location", rules).alias("borough"),
        F.upper("raw_location").alias("station_name"),
        F.split("start_time", "T")[0].alias("crash_date"),
        first_int("temperature_raw", signed, to="double").alias("temperature"),
        "is_daytime",
        first_int("wind_speed_raw", signed).alias("wind_speed_mph"),
        F.col("dewpoint_raw").alias("dewpoint_celsius"),
        F.col("precip_prob_raw").alias("precip_prob"),
        F.col("humidity_raw").alias("humidity"),
        "weather_description",
    )


def map_to_columns(
    df: DataFrame, map_col: str, labels: Sequence[str], default: float | None = 0.0, keep: Sequence[Column | str] = ()
) -> DataFrame:
    """One double column per label from a map; other labels are dropped."""
    out = []
    for label in labels:
        value = F.try_element_at(F.col(map_col), F.lit(label)).try_cast("double")
        out.append((value if default is None else F.coalesce(value, F.lit(float(default)))).alias(label))
    return df.select(*keep, *out)


def camera_rows(df: DataFrame, doc: str = "doc", labels: Sequence[str] = CAMERA_LABELS, keep: Sequence[str] = ()) -> DataFrame:
    """Trusted camera record of each report: fixed label columns and the borough."""
    camera = F.coalesce(F.col(f"{doc}.camera_id"), F.lit(""))
    fields = [
        *keep,
        camera.alias("camera_id"),
        F.coalesce(F.col(f"{doc}.date"), F.lit("")).alias("crash_date"),
        F.coalesce(F.col(f"{doc}.total_frames_processed").try_cast("double").try_cast("int"), F.lit(0)).alias("total_frames_processed"),
    ]
    rows = map_to_columns(df, f"{doc}.avg_per_frame", labels, 0.0, keep=fields)
    return rows.withColumns(
        {"borough": rule_map("camera_id", CAMERA_RULES), "camera_id_original": F.upper("camera_id")}
    )


def report_labels(df: DataFrame, map_col: str, max_labels: int = 10_000) -> list[str]:
    """Sorted distinct labels of a map column; refuses vocabularies too wide for columns."""
    found = df.select(F.explode(F.map_keys(map_col)).alias("label")).distinct().limit(max_labels + 1).collect()
    if len(found) > max_labels:
        raise ValueError(f"more than {max_labels} labels cannot become columns; keep the long form")
    return sorted(r["label"] for r in found)


def report_table(df: DataFrame, doc: str = "doc", source: str = "source_file", labels: Sequence[str] | None = None) -> DataFrame:
    """Landing record of each report, one nullable column per label seen in any report."""
    if labels is None:
        labels = report_labels(df, f"{doc}.avg_per_frame")
    fields = [
        F.coalesce(F.col(f"{doc}.camera_id"), F.lit("unknown_camera")).alias("camera_id"),
        F.col(f"{doc}.date").alias("timestamp"),
        F.coalesce(F.col(f"{doc}.total_frames_processed").try_cast("double").try_cast("bigint"), F.lit(0)).alias("total_frames"),
        F.col(source).alias("source_file"),
    ]
    return map_to_columns(df, f"{doc}.avg_per_frame", labels, None, keep=fields)


def label_counts(df: DataFrame, folder: str, content: str) -> DataFrame:
    """``(folder, label, n)`` from annotation JSON with ``shapes[].label``."""
    shapes = F.from_json(F.col(content), "shapes array<struct<label: string>>")["shapes"]
    return (
        df.select(folder, F.explode_outer(shapes).alias("shape"))
        .filter("shape is not null")
        .groupBy(folder, F.col("shape.label").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def camera_of_folder(folder: Column | str) -> Column:
    """First two ``_`` parts of a folder name, or all of it when there are fewer."""
    return F.array_join(F.slice(F.split(as_col(folder), "_"), 1, 2), "_")


def camera_folders(df: DataFrame, folder: str) -> DataFrame:
    """``(camera_id, folder)`` in playing order: by camera, then folder name.

    Kept as rows and range-sorted rather than as one list per camera, so a camera
    owning most folders spreads over several partitions.
    """
    return df.select(camera_of_folder(folder).alias("camera_id"), folder).distinct().orderBy("camera_id", folder)
