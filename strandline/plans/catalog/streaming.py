"""Camera-frame queries: event-time windows (batch and stream), anchored windows, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.plans.catalog import inputs
from strandline.plans.catalog.inputs import FRAMES_SQL, registry, table
from strandline.session import materialize, scratch_path
from strandline.sources.framelog import log_frames
from strandline.streaming import anchored, frames, replay

QUERIES, query = registry()

# printf rounds the exact binary value half to even, as round_half_even does.
_AVERAGES_SQL = """
    counts AS (SELECT win, camera_id, count(*) AS frames FROM placed GROUP BY ALL),
    sums AS (SELECT win, camera_id, label, sum(n)::BIGINT AS total FROM placed WHERE label IS NOT NULL GROUP BY ALL),
    averaged AS (SELECT win, camera_id, label, frames, total, printf('%.2f', total / frames::DOUBLE)::DOUBLE AS avg_per_frame
                 FROM counts LEFT JOIN sums USING (win, camera_id))
"""
_WINDOWS_SQL = f"""
    {FRAMES_SQL},
    placed AS (SELECT date_trunc('hour', ts) AS win, camera_id, label, n FROM frames),
    {_AVERAGES_SQL}
"""
_SELECT_SQL = "SELECT strftime(win, '%Y-%m-%d %H:%M:%S') AS window_start, camera_id, label, frames, total, avg_per_frame FROM averaged"


def _with_text_start(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(f"WITH {_WINDOWS_SQL} {_SELECT_SQL}")
def camera_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _with_text_start(frames.windowed_averages(inputs.frames(spark, sf), width="1 hour"))


@query(f"""
    WITH {_WINDOWS_SQL} {_SELECT_SQL}
    WHERE win + INTERVAL 1 HOUR <= (SELECT max(date_trunc('milliseconds', ts)) - INTERVAL 10 MINUTE FROM events)
""")
def camera_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same windows through a stream; those still open at the watermark are not emitted."""
    schema = table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    stream = source.select(
        F.concat(F.lit("Nd_"), F.col("user_id").cast("string")).alias("camera_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") != "error", F.create_map(F.col("event_type"), F.floor("value").cast("bigint"))).alias(
            "detections"
        ),
    )
    totals = frames.windowed_totals(stream, width="1 hour", watermark="10 minutes")
    out, checkpoint = scratch_path(spark, "windows"), scratch_path(spark, "checkpoint")

    def save(batch: DataFrame, batch_id: int) -> None:
        frames.averages(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = totals.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    writer.trigger(availableNow=True).start().awaitTermination()
    return _with_text_start(spark.read.parquet(out).drop("batch_id"))


@query(f"""
    WITH {_WINDOWS_SQL}
    SELECT camera_id, strftime(win, '%Y-%m-%d') AS "date", 'meta_unstructured_report_' || camera_id || '_'
               || strftime(win - INTERVAL 5 HOUR, '%H%M%S') || '.json' AS report_name,
           max(frames) AS total_frames_processed, count(label) AS label_count,
           round(coalesce(sum(avg_per_frame), 0), 2) AS avg_sum
    FROM averaged GROUP BY win, camera_id
""")
def camera_reports(spark: SparkSession, sf: str) -> DataFrame:
    """All events fall in January, when New York is five hours behind UTC."""
    averaged = frames.windowed_averages(inputs.frames(spark, sf), width="1 hour")
    averaged = averaged.withColumn("window_start", F.col("window_start").cast("timestamp"))
    values = F.map_values("avg_per_frame")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return frames.reports(averaged).select(
        "camera_id",
        "date",
        "report_name",
        "total_frames_processed",
        F.size("avg_per_frame").cast("bigint").alias("label_count"),
        F.round(total, 2).alias("avg_sum"),
    )


@query("""
    SELECT event_id, 'Nd_' || user_id || '/' || strftime(ts, '%Y-%m-%d') || '/' || strftime(ts, '%H%M%S') || '_' || event_id || '.jpg' AS path,
           strlen(props)::INT AS byte_count, sha256(props) AS checksum
    FROM events
""")
def frame_files(spark: SparkSession, sf: str) -> DataFrame:
    """Messages as JSON text with a base64 payload, parsed and decoded to (path, bytes)."""
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    message = F.to_json(
        F.struct(
            F.concat(F.lit("Nd_"), F.col("user_id").cast("string")).alias("video_id"),
            F.col("event_id").cast("string").alias("frame_id"),
            F.base64(F.col("props").cast("binary")).alias("image_data"),
            epoch.alias("timestamp"),
        )
    )
    parsed = frames.parse_frames(table(spark, sf, "events").select(message.alias("value")))
    files = frames.frame_files(parsed)
    return files.select(
        F.regexp_extract("path", r"_(\d+)\.jpg$", 1).cast("bigint").alias("event_id"),
        "path",
        F.octet_length("content").alias("byte_count"),
        F.sha2("content", 256).alias("checksum"),
    )


_ANCHORED_SQL = f"""
    WITH RECURSIVE {FRAMES_SQL},
    ticked AS (SELECT *, floor(epoch_us(ts) / 60000000)::BIGINT AS tick FROM frames),
    ticks AS (SELECT DISTINCT camera_id, tick FROM ticked),
    steps(camera_id, win, win_end) AS (
        SELECT camera_id, min(tick), min(tick) + 60 FROM ticks GROUP BY camera_id
        UNION ALL
        SELECT camera_id, win_end, CASE WHEN next_tick <= win_end + 60 THEN win_end + 60 ELSE next_tick END
        FROM (SELECT s.camera_id, s.win_end, min(t.tick) AS next_tick FROM steps s JOIN ticks t
                  ON t.camera_id = s.camera_id AND t.tick > s.win_end GROUP BY ALL)),
    placed AS (SELECT s.win, t.camera_id, t.label, t.n, s.win_end FROM ticked t JOIN steps s
                   ON t.camera_id = s.camera_id AND t.tick <= s.win_end
                  AND (t.tick > s.win OR s.win = (SELECT min(tick) FROM ticks k WHERE k.camera_id = t.camera_id) AND t.tick = s.win)),
    {_AVERAGES_SQL}
    SELECT camera_id, win AS window_start, label, frames, total, avg_per_frame, win_end AS window_end
    FROM averaged JOIN steps USING (camera_id, win)
"""


@query(f"{_ANCHORED_SQL} WHERE win_end <= (SELECT max(tick) FROM ticks)")
def anchored_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Hour-long windows from each camera's first frame, polled every minute; starts in minutes."""
    return anchored.anchored_windows(inputs.frames(spark, sf), width=3600, tick=60, block_ticks=1440)


def _frame_parts(spark: SparkSession, sf: str, count: int) -> list[DataFrame]:
    """The frames in ``count`` parts of equal time, earliest first."""
    rows = inputs.frames(spark, sf).select("camera_id", F.col("ts").cast("timestamp").alias("ts"), "detections")
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        return [rows] * count
    step = (high - low) / count
    ends = [low + step * i for i in range(1, count)]
    place = sum((F.when(F.col("ts") >= F.lit(e), 1).otherwise(0) for e in ends), F.lit(0))
    return [rows.filter(place == i) for i in range(count)]


@query(f"{_ANCHORED_SQL} WHERE (win_end + 1) * 60000 <= (SELECT epoch_ms(max(ts)) FROM events)")
def anchored_windows_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The anchored windows from keyed state with timers, by a query that is stopped and started again between the parts of
    the recording. Windows whose closing minute the watermark has not passed stay in the state."""
    source, out, checkpoint = (scratch_path(spark, x) for x in ("frames", "windows", "checkpoint"))
    for part in _frame_parts(spark, sf, 3):
        part.write.mode("append").parquet(source)
        closed = replay.anchored_replay(spark.readStream.schema(part.schema).parquet(source), width=3600, tick=60)
        writer = closed.writeStream.option("checkpointLocation", checkpoint).format("parquet").option("path", out)
        writer.trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.schema(replay.CLOSED).parquet(out)
    return frames.averages(stored, keep=["window_end"])


@query(f"""
    WITH seen AS (SELECT 'Nd_' || user_id AS camera_id, ts FROM events),
    span AS (SELECT min(ts) AS low, epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM seen),
    steps AS (SELECT step, low + to_microseconds(us * step // 4) AS upto FROM span, range(1, 5) AS r(step))
    SELECT step::INT AS step, camera_id, count(*) AS frames, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen
    FROM seen JOIN steps ON step = 4 OR ts < upto GROUP BY ALL
""")
def camera_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Frames so far of each camera, read after each quarter of the recording; the query restarts in between."""
    source, out, checkpoint = (scratch_path(spark, x) for x in ("frames", "progress", "checkpoint"))
    found = None
    for step, part in enumerate(_frame_parts(spark, sf, 4), 1):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        frames.start_progress(stream, out, checkpoint, availableNow=True).awaitTermination()
        now = frames.latest_progress(spark.read.parquet(out)).withColumn("step", F.lit(step))
        # the folder grows with the next step, so each reading is written down
        now = materialize(now.select("step", "camera_id", "frames", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen")), "progress")
        found = now if found is None else found.union(now)
    return found


@query(f"""
    WITH {FRAMES_SQL}
    SELECT camera_id, frame_id, label, CASE WHEN label IS NOT NULL THEN n END AS n, count(*) AS times_read FROM frames GROUP BY ALL
""")
def frame_log_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Frame messages through a log folder: half of them are read, the log grows, and a restarted query reads the others."""
    log, out, checkpoint = (scratch_path(spark, n) for n in ("log", "frames", "checkpoint"))
    sent = inputs.frames(spark, sf).select(
        (F.col("frame_id").cast("bigint") % 2).alias("half"),
        F.to_json(F.struct(F.col("camera_id").alias("video_id"), "frame_id", F.unix_seconds(F.col("ts").cast("timestamp")).cast("double").alias("timestamp"), "detections")).alias("value"),
    )
    for half in (0, 1):
        sent.where(F.col("half") == half).select("value").write.mode("append").text(log)
        parsed = frames.parse_frames(log_frames(spark, log))
        writer = parsed.select("camera_id", "frame_id", F.explode_outer("detections").alias("label", "n"))
        writer = writer.writeStream.option("checkpointLocation", checkpoint).format("parquet").trigger(availableNow=True)
        writer.start(out).awaitTermination()
    return spark.read.parquet(out).groupBy("camera_id", "frame_id", "label", "n").agg(F.count("*").alias("times_read"))
