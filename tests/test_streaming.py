import base64
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from strandline.plans.cameras import trusted_reports, watch_cameras
from strandline.streaming import anchored, frames


def message(camera, at, detections=None, frame="f", image=b"img"):
    body = {"video_id": camera, "frame_id": frame, "timestamp": at, "image_data": base64.b64encode(image).decode()}
    if detections is not None:
        body["detections"] = detections
    return json.dumps(body)


T0 = 1_704_067_200.0  # 2024-01-01 00:00:00 UTC, 19:00 the day before in New York


def test_parse_and_averages(spark):
    texts = [
        message("Nd_O", T0, {"car": 3}), message("Nd_O", T0 + 1, {"car": 1, "bus": 1}), message("Nd_O", T0 + 2),
        message("Nd_O", T0 + 15, {"car": 5}), message("SW_O", T0 + 3, {}), json.dumps({"video_id": "SW_O", "timestamp": T0 + 4}),
    ]
    parsed = frames.parse_frames(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert parsed.filter("image_data = ''").count() == 1 and parsed.filter("detections is null").isEmpty()
    got = {(r["camera_id"], str(r["window_start"])[-8:], r["label"]): (r["frames"], r["total"], r["avg_per_frame"])
           for r in frames.windowed_averages(parsed).collect()}
    # The denominator is every frame of the window, with or without the label.
    assert got == {
        ("Nd_O", "00:00:00", "car"): (3, 4, 1.33),
        ("Nd_O", "00:00:00", "bus"): (3, 1, 0.33),
        ("Nd_O", "00:00:15", "car"): (1, 5, 5.0),
        ("SW_O", "00:00:00", None): (2, None, None),
    }
    docs = {(r["camera_id"], r["report_name"]): r for r in frames.reports(frames.windowed_averages(parsed)).collect()}
    first = docs[("Nd_O", "meta_unstructured_report_Nd_O_190000.json")]
    assert first["avg_per_frame"] == {"bus": 0.33, "car": 1.33} and first["total_frames_processed"] == 3
    assert docs[("SW_O", "meta_unstructured_report_SW_O_190000.json")]["avg_per_frame"] == {}
    files = {r["path"]: bytes(r["content"]) for r in frames.frame_files(parsed.limit(1)).collect()}
    assert files == {"Nd_O/2024-01-01/000000_f.jpg": b"img"}


def test_report_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, check = str(tmp_path / "out"), str(tmp_path / "ck")

    def run(name, texts):
        (source / name).write_text("\n".join(texts) + "\n")
        stream = spark.readStream.text(str(source))
        watch_cameras(stream, out, check, availableNow=True).awaitTermination()

    run("a.txt", [message("Nd_O", T0 + s, {"car": 1}) for s in range(0, 40, 5)])
    run("b.txt", [message("Nd_O", T0 + 41, {"car": 9}), message("Nd_O", T0 + 1, {"car": 100}), message("Nd_O", T0 + 120, {})])
    rows = spark.read.parquet(out)
    got = {str(r["window_start"])[-8:]: (r["total_frames_processed"], r["avg_per_frame"]) for r in rows.collect()}
    # The frame 41 s in still finds its window open across the restart; the late one is dropped.
    assert got == {"00:00:00": (3, {"car": 1.0}), "00:00:15": (3, {"car": 1.0}), "00:00:30": (3, {"car": 3.67})}
    trusted = trusted_reports(rows)
    assert trusted.filter("borough = 'MANHATTAN'").count() == 3 and "e-Rickshaw" in trusted.columns


def poll_every_tick(ticks, width):
    """Plain simulation: one poll per tick, as a single consumer would run."""
    start, pending, owner, seen = None, [], {}, set(ticks)
    for now in range(min(ticks), max(ticks) + 1):
        if now in seen:
            start = now if start is None else start
            pending.append(now)
        if pending and now - start >= width:
            owner.update(dict.fromkeys(pending, start))
            start, pending = now, []
    owner.update(dict.fromkeys(pending, start))
    return owner


def test_anchored_blocks_against_a_plain_simulation():
    random.seed(11)
    for _ in range(1500):
        width = random.randint(1, 9)
        block = random.randint(width, 25)
        span = random.choice([40, 120, 400])
        ticks = sorted({random.randint(0, span) for _ in range(random.randint(1, 40))})
        blocks = {}
        for t in ticks:
            blocks.setdefault(t // block, []).append(t)
        maps = []
        for b, seen in blocks.items():
            starts, open_ = anchored._exits(seen, b * block, (b + 1) * block, width)
            maps.append({"block": b, "starts": starts, "open": open_})
        got = {}
        for b, start, pending in anchored._chain(maps, block, width):
            owner, _, _ = anchored._walk(blocks[b], (b + 1) * block, start, pending, width)
            got.update(zip(blocks[b], owner))
        assert got == poll_every_tick(ticks, width)


def test_anchored_windows(spark):
    random.seed(4)
    rows = [(f"c{i % 3}", T0 + random.randint(0, 900), {"car": random.randint(0, 3)}) for i in range(200)]
    df = spark.createDataFrame(rows, "camera_id string, s double, detections map<string,bigint>").withColumn("ts", F.timestamp_seconds("s"))
    got = {(r["camera_id"], r["window_start"]): (r["frames"], r["total"])
           for r in anchored.anchored_windows(df, block_ticks=60, keep_open=True).collect()}
    expected = {}
    for camera in ("c0", "c1", "c2"):
        mine = [(int(s), d["car"]) for c, s, d in rows if c == camera]
        owner = poll_every_tick(sorted({t for t, _ in mine}), 15)
        for t, n in mine:
            f, total = expected.get((camera, owner[t]), (0, 0))
            expected[(camera, owner[t])] = (f + 1, total + n)
    assert got == expected


def test_one_poll_of_the_stream_state():
    state, closed = anchored.advance(None, 100.0, 2, {"car": 3}, 15)
    assert closed is None and state == (100.0, 2, {"car": 3})
    state, closed = anchored.advance(state, 115.0, 1, {"bus": 1}, 15)
    assert closed == (100.0, 3, {"car": 3, "bus": 1}) and state == (115.0, 0, {})
    idle, closed = anchored.advance(state, 140.0, 0, {}, 15)
    assert closed is None and idle == (115.0, 0, {})
    state, closed = anchored.advance(idle, 150.0, 1, {}, 15)
    assert closed == (115.0, 1, {}) and state[0] == 150.0


def test_anchored_stream_closes_idle_windows_by_timer(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.txt").write_text("\n".join(message("Nd_O", T0 + i, {"car": 2}) for i in range(10)) + "\n")
    closed = anchored.anchored_stream(frames.parse_frames(spark.readStream.text(str(source))), width=2)
    query = (
        closed.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(processingTime="500 milliseconds").start()
    )
    try:
        deadline = time.time() + 60
        rows = []
        while time.time() < deadline and not rows:
            time.sleep(1)
            rows = [r for r in spark.read.schema(closed.schema).parquet(out).collect()] if (tmp_path / "out").exists() else []
    finally:
        query.stop()
    assert sorted(((r["label"] or "", r["frames"], r["total"]) for r in rows)) == [("", 10, 10), ("car", 10, 20)]


def test_frames_are_combined_before_the_shuffle(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stream = anchored.anchored_stream(frames.parse_frames(spark.readStream.text(str(source))))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert plan.index("FlatMapGroupsInPandasWithState") < plan.index("MapInPandas")


def test_progress_listener():
    class Progress:
        id, name, numInputRows = "q", "cameras", 4

    class Event:
        id, progress = "q", Progress

    lines = []
    listener = frames.FrameProgress(lines.append)
    listener.onQueryStarted(Event)
    listener.onQueryProgress(Event)
    listener.onQueryProgress(Event)
    assert lines[-1] == "cameras: 8 frames so far"


@pytest.mark.parametrize("width", ["15 seconds", "1 hour"])
def test_stream_and_table_forms_agree(spark, tmp_path, width):
    random.seed(8)
    texts = [message(f"c{i % 4}", T0 + i * 7, {"car": i % 3}) for i in range(300)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text("\n".join(texts) + "\n")
    stream = frames.windowed_totals(frames.parse_frames(spark.readStream.text(str(tmp_path / "in"))), width=width, watermark="0 seconds")
    name = f"agree_{width.split()[1]}"
    stream.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    table = frames.windowed_totals(frames.parse_frames(spark.createDataFrame([(t,) for t in texts], "value string")), width=width)
    assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, table.collect()))


def test_broken_messages_are_no_frames(spark):
    good = '{"video_id": "Nd_O", "frame_id": "f1", "timestamp": 1.5}'
    df = spark.createDataFrame([(good,), ("not json",), ('{"frame_id": "f2"}',), (None,)], "value string")
    assert [r["camera_id"] for r in frames.parse_frames(df).collect()] == ["Nd_O"]
    assert sorted((r["raw"] or "", r["error"]) for r in frames.bad_frames(df).collect()) == [
        ("", "invalid_json"), ("not json", "invalid_json"), ('{"frame_id": "f2"}', "no_camera"),
    ]
