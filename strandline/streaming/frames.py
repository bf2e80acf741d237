"""Frame messages to per-camera window averages: event-time windows, reports, frame files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from strandline.functions.columns import as_col, round_half_even
from strandline.operators.landing import REPORT_NAME_PREFIX

FRAME_SCHEMA = """
    video_id string, source_folder string, frame_id string, image_data string,
    detections map<string, bigint>, timestamp double
"""
WINDOW_SECONDS = 15
REPORT_ZONE = "America/New_York"


def parse_frames(df: DataFrame, value: str = "value") -> DataFrame:
    """Frame columns from JSON messages; no detections means an empty map, no image an empty text.

    A message that names no camera, or is no JSON object, is no frame: see :func:`bad_frames`.
    """
    frame = df.select(F.from_json(value, FRAME_SCHEMA).alias("f")).filter("f.video_id IS NOT NULL")
    return frame.select(
        F.col("f.video_id").alias("camera_id"),
        "f.source_folder",
        "f.frame_id",
        F.coalesce("f.image_data", F.lit("")).alias("image_data"),
        F.coalesce("f.detections", F.create_map().cast("map<string,bigint>")).alias("detections"),
        F.timestamp_micros((F.col("f.timestamp") * 1_000_000).cast("bigint")).alias("ts"),
    )


def bad_frames(df: DataFrame, value: str = "value") -> DataFrame:
    """``(raw, error)`` of the messages that :func:`parse_frames` leaves out."""
    parsed = df.select(F.col(value).alias("raw"), F.from_json(value, f"{FRAME_SCHEMA}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("f"))
    broken = F.col("raw").isNull() | F.col("f").isNull() | F.col("f._corrupt_record").isNotNull()
    error = F.when(broken, F.lit("invalid_json")).otherwise(F.lit("no_camera"))
    return parsed.filter("f.video_id IS NULL").select("raw", error.alias("error"))


def counted_labels(detections: Column | str) -> Column:
    """Per frame: one entry per label, and one with a null label that counts the frame.

    Map keys are never null, so the frame entry cannot clash with a label, and
    frames and labels share one aggregation.
    """
    frame = F.array(F.struct(F.lit(None).cast("string").alias("label"), F.lit(1).cast("bigint").alias("n")))
    labels = F.transform(
        F.map_entries(as_col(detections)),
        lambda e: F.struct(e["key"].alias("label"), e["value"].cast("bigint").alias("n")),
    )
    return F.concat(frame, F.coalesce(labels, F.array().cast("array<struct<label:string,n:bigint>>")))


def windowed_totals(
    df: DataFrame,
    ts: str = "ts",
    camera: str = "camera_id",
    detections: str = "detections",
    width: str = f"{WINDOW_SECONDS} seconds",
    watermark: str | None = None,
) -> DataFrame:
    """``(window_start, camera, label, total)``; works on tables and, with a watermark, on streams."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    entries = df.select(ts, camera, F.explode(counted_labels(detections)).alias("e"))
    window = F.window(ts, width)
    totals = entries.groupBy(window.alias("w"), F.col(camera), F.col("e.label").alias("label")).agg(F.sum("e.n").alias("total"))
    return totals.select(F.col("w.start").alias("window_start"), camera, "label", "total")


def averages(
    totals: DataFrame, camera: str = "camera_id", window: str = "window_start", keep: Sequence[str] = ()
) -> DataFrame:
    """``avg_per_frame`` of each label over all frames of its window, rounded to 2 decimals.

    A window without any detection keeps one row with a null label.
    """
    group = Window.partitionBy(window, camera)
    frames = F.max(F.when(F.col("label").isNull(), F.col("total"))).over(group)
    labels = F.count("label").over(group)
    rows = totals.withColumns({"frames": frames, "__labels": labels})
    rows = rows.filter(F.col("label").isNotNull() | (F.col("__labels") == 0)).drop("__labels")
    ratio = F.col("total").cast("double") / F.col("frames")
    total = F.when(F.col("label").isNotNull(), F.col("total"))
    mean = F.when(F.col("label").isNotNull(), round_half_even(ratio))
    return rows.select(*keep, window, camera, "label", "frames", total.alias("total"), mean.alias("avg_per_frame"))


def windowed_averages(
    df: DataFrame,
    ts: str = "ts",
    camera: str = "camera_id",
    detections: str = "detections",
    width: str = f"{WINDOW_SECONDS} seconds",
) -> DataFrame:
    """Batch form: totals, then averages."""
    return averages(windowed_totals(df, ts, camera, detections, width), camera)


def report_name(camera: Column, window_start: Column, zone: str = REPORT_ZONE) -> Column:
    local = F.from_utc_timestamp(F.to_utc_timestamp(window_start, F.current_timezone()), zone)
    return F.concat(F.lit(REPORT_NAME_PREFIX), camera, F.lit("_"), F.date_format(local, "HHmmss"), F.lit(".json"))


def reports(averaged: DataFrame, camera: str = "camera_id", window: str = "window_start") -> DataFrame:
    """One report document per camera and window, with its file name.

    Only the distinct labels of one window meet in a report's map; frames were
    already summed.
    """
    label = F.struct("label", "avg_per_frame")
    per_window = averaged.groupBy(camera, window).agg(
        F.max("frames").alias("total_frames_processed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), label)))).alias("avg_per_frame"),
    )
    return per_window.select(
        F.col(camera).alias("camera_id"),
        window,
        F.date_format(window, "yyyy-MM-dd").alias("date"),
        "avg_per_frame",
        "total_frames_processed",
        report_name(F.col(camera), F.col(window)).alias("report_name"),
    )


def frame_files(frames: DataFrame, at: Column | str = "ts") -> DataFrame:
    """Decoded image bytes with their path ``<camera>/<date>/<HHmmss>_<frame>.jpg``."""
    at = as_col(at)
    path = F.concat_ws(
        "/",
        F.col("camera_id"),
        F.date_format(at, "yyyy-MM-dd"),
        F.concat(F.date_format(at, "HHmmss"), F.lit("_"), F.col("frame_id"), F.lit(".jpg")),
    )
    return frames.select(
        "camera_id", F.date_format(at, "yyyy-MM-dd").alias("date"), path.alias("path"), F.unbase64("image_data").alias("content")
    )


def start_reports(
    frames: DataFrame,
    out: str,
    checkpoint: str,
    width: str = f"{WINDOW_SECONDS} seconds",
    watermark: str = f"{WINDOW_SECONDS} seconds",
    **trigger,
) -> StreamingQuery:
    """Append closed windows as report rows; one folder per batch, so a retry overwrites itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        done = reports(averages(batch))
        done.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    totals = windowed_totals(frames, width=width, watermark=watermark)
    writer = totals.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_frame_files(frames: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write every decoded frame to its file as batches arrive."""
    from strandline.sources.writers import write_files

    def save(batch: DataFrame, batch_id: int) -> None:
        write_files(frame_files(batch), out, "path", "content")

    writer = frames.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_progress(frames: DataFrame, out: str, checkpoint: str, camera: str = "camera_id", **trigger) -> StreamingQuery:
    """Frames so far of each camera, as (camera, frames, first_seen, last_seen) rows of the cameras that changed.

    Counts are the query's state, so they go on over restarts. One folder per batch, so a retry overwrites
    itself; by default a batch starts every ``WINDOW_SECONDS``. Read with :func:`latest_progress`.
    """
    counted = frames.groupBy(camera).agg(F.count(F.lit(1)).alias("frames"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    writer = counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return writer.trigger(**(trigger or {"processingTime": f"{WINDOW_SECONDS} seconds"})).start()


def latest_progress(progress: DataFrame, camera: str = "camera_id") -> DataFrame:
    """The newest row of each camera from the batches that :func:`start_progress` has written."""
    values = F.struct(*[c for c in progress.columns if c not in (camera, "batch_id")])
    newest = progress.groupBy(camera).agg(F.max_by(values, "batch_id").alias("v"))
    return newest.select(camera, "v.*")


class FrameProgress(StreamingQueryListener):
    """Reports frames so far for each query through ``emit`` (``print`` by default)."""

    def __init__(self, emit=print) -> None:
        self.emit = emit
        self.frames: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.frames[str(event.id)] = 0

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = self.frames.get(str(progress.id), 0) + max(0, progress.numInputRows)
        self.frames[str(progress.id)] = seen
        self.emit(f"{progress.name or progress.id}: {seen} frames so far")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
