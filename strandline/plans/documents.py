"""Trusted zone of weather forecasts and camera reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.operators.cleaning import reason_counts
from strandline.operators.documents import camera_rows, explode_periods, weather_rows
from strandline.session import materialize
from strandline.sources.readers import read_camera_reports, read_weather
from strandline.sources.writers import replace_documents


def trust_weather(spark: SparkSession, source: str, out: str) -> DataFrame:
    """The periods of all readable forecast files below ``source``; returns files per outcome.

    The table is replaced as a whole: a second run over the same files changes nothing.
    """
    parsed = materialize(read_weather(spark, source).drop("content"), "weather")
    replace_documents(weather_rows(explode_periods(parsed)), out)
    return reason_counts(parsed)


def trust_cameras(spark: SparkSession, source: str, out: str) -> DataFrame:
    """One row per readable camera report below ``source``, replacing the table; returns files per outcome."""
    parsed = materialize(read_camera_reports(spark, source).drop("content"), "cameras")
    replace_documents(camera_rows(parsed.filter("error is null")), out)
    return reason_counts(parsed)
