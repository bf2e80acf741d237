"""Camera stream flow: frame messages to report documents, straight into the trusted table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.functions.columns import CAMERA_RULES, rule_map
from strandline.operators.documents import CAMERA_LABELS, map_to_columns
from strandline.streaming.frames import parse_frames, start_reports


def watch_cameras(messages: DataFrame, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Start the report stream over raw messages (a ``value`` text column)."""
    return start_reports(parse_frames(messages), out, checkpoint, **options)


def trusted_reports(reports: DataFrame) -> DataFrame:
    """Trusted camera rows from stored report rows, without a detour through JSON files."""
    fields = ["camera_id", F.col("date").alias("crash_date"), F.col("total_frames_processed").cast("int").alias("total_frames_processed")]
    rows = map_to_columns(reports, "avg_per_frame", CAMERA_LABELS, 0.0, keep=fields)
    return rows.withColumns({"borough": rule_map("camera_id", CAMERA_RULES), "camera_id_original": F.upper("camera_id")})
