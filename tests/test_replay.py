"""Anchored windows from keyed state, and per-camera progress, over restarts."""

import random

import pandas as pd
from pyspark.sql import functions as F

from strandline.streaming import anchored, frames, replay


class Counting(replay.AnchoredWindows):
    """A later version of the state: one more variable, started on the old checkpoint."""

    def init(self, handle):
        super().init(handle)
        self.closed = handle.getValueState("closed", "n bigint")

    def _emit(self, camera, start, end):
        n = (self.closed.get() or (0,))[0] + 1
        self.closed.update((n,))
        return [*super()._emit(camera, start, end), (camera, start, end, "__closed", n)]


def recording(spark, seed, n=260, span=2_000):
    rng = random.Random(seed)
    rows = [(f"c{rng.randrange(3)}", 1_704_067_200 + rng.randrange(span) + rng.random() * 0.9, rng.choice(({"car": 2}, {"car": 1, "bus": 3}, {"": 4}, {}, None))) for _ in range(n)]
    rows.sort(key=lambda r: r[1])
    df = spark.createDataFrame(rows, "camera_id string, s double, detections map<string,bigint>")
    return df.select("camera_id", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")).alias("ts"), "detections")


def run(spark, parts, tmp_path, processors, **options):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for part, processor in zip(parts, processors):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 3).parquet(source)
        closed = replay.anchored_replay(stream, processor=processor, **options)
        closed.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(replay.CLOSED).parquet(out)


def long_form(df):
    return {tuple(r) for r in df.select("camera_id", "window_start", "window_end", "label", "frames", "total").collect()}


def test_restarts_and_unordered_files_equal_the_batch_form(spark, tmp_path):
    df = recording(spark, 3).withColumn("k", F.unix_seconds("ts") % 1000)
    low = df.agg(F.min(F.unix_seconds("ts"))).first()[0]
    # two parts in time; within a part the files come in any order, covered by the delay
    parts = [df.filter(F.unix_seconds("ts") < low + 900).drop("k").repartition(6), df.filter(F.unix_seconds("ts") >= low + 900).drop("k").repartition(6)]
    got = run(spark, parts, tmp_path, [replay.AnchoredWindows, Counting], width=15, tick=1, delay="2000 seconds")
    assert got.count() == 0  # nothing has passed the watermark yet
    flush = spark.createDataFrame([("flush", low + 9_000.0, None)], "camera_id string, s double, detections map<string,bigint>")
    flush = flush.select("camera_id", F.timestamp_seconds("s").alias("ts"), "detections")
    got = run(spark, [flush], tmp_path, [Counting], width=15, tick=1, delay="2000 seconds")
    closed = {(r["camera_id"], r["total"]) for r in got.filter("label = '__closed'").collect()}
    want = long_form(anchored.anchored_windows(df, keep_open=True))
    assert long_form(frames.averages(got.filter("label is null or label <> '__closed'"), keep=["window_end"])) == want
    assert closed == {(c, n) for c in ("c0", "c1", "c2") for n in range(1, len({w[1] for w in want if w[0] == c}) + 1)}


def test_parts_in_time(spark, tmp_path):
    df = recording(spark, 5)
    low, high = df.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_micros("ts"))).first()
    parts = [df.filter(F.floor((F.unix_seconds("ts") - low) / 700) == i) for i in range(3)]
    got = run(spark, [p.coalesce(1) for p in parts], tmp_path, [replay.AnchoredWindows] * 3, width=15, tick=1)
    want = long_form(anchored.anchored_windows(df))
    assert long_form(frames.averages(got, keep=["window_end"])) == {w for w in want if (w[2] + 1) * 1_000 <= high // 1_000}
    assert "TransformWithState" in replay.anchored_replay(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))._jdf.queryExecution().analyzed().toString()


def test_progress_per_camera(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "ck"))
    df = recording(spark, 9)
    total = {}
    for i in range(3):
        part = df.filter(F.pmod(F.xxhash64("ts"), F.lit(3)) == i)
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        frames.start_progress(stream, out, check, availableNow=True).awaitTermination()
        for r in part.groupBy("camera_id").count().collect():
            total[r["camera_id"]] = total.get(r["camera_id"], 0) + r["count"]
        seen = frames.latest_progress(spark.read.parquet(out))
        assert {r["camera_id"]: r["frames"] for r in seen.collect()} == total
    assert sum(total.values()) == 260


class Counted:
    """State in memory that counts the calls made to it."""

    def __init__(self):
        self.calls, self.timers, self.names = 0, set(), {}

    def getValueState(self, name, *schemas):
        return self.names.setdefault(name, Cell(self))

    getMapState = getListState = getValueState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Cell:
    def __init__(self, handle):
        self.handle, self.value, self.map, self.list = handle, None, {}, []

    def __getattribute__(self, name):
        if name in ("get", "update", "iterator", "containsKey", "getValue", "updateValue", "removeKey", "clear", "put", "appendList"):
            self.handle.calls += 1
        return object.__getattribute__(self, name)

    def get(self):
        return iter(list(self.list)) if self is self.handle.names.get("arrived") else self.value

    def update(self, value):
        self.value = value

    def put(self, rows):
        self.list = list(rows)

    def appendList(self, rows):
        self.list += rows

    def clear(self):
        self.map, self.list = {}, []

    def containsKey(self, key):
        return key in self.map

    def getValue(self, key):
        return self.map.get(key)

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]

    def iterator(self):
        return iter(list(self.map.items()))


class At:
    def __init__(self, ms):
        self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: ms


def replayed(ticks, before=()):
    handle, processor = Counted(), replay.AnchoredWindows(5, 1000)
    processor.init(handle)
    for at, n in before:  # as a checkpoint of the earlier form holds them
        handle.names["waiting"].map[at] = (n,)
    rows = pd.DataFrame([(t, label, 1) for t in ticks for label in (None, "car")], columns=["tick", "label", "n"])
    list(processor.handleInputRows(("c",), iter([rows]), At(0)))
    timers = len(handle.timers)
    found = [tuple(r) for df in processor.handleExpiredTimer(("c",), At(10**9), At(10**9)) for r in df.itertuples(index=False)]
    return handle, timers, [(s, e, None if label != label else label, n) for _, s, e, label, n in found]


def test_calls_to_state_do_not_grow_with_the_ticks_of_a_batch():
    few, many = replayed(range(10, 30)), replayed(range(10, 2010))
    assert few[1] == many[1] == 1
    assert many[0].calls == few[0].calls < 20
    assert sum(n for *_, label, n in many[2] if label is None) == 2000


def test_ticks_of_an_earlier_checkpoint_are_taken():
    waiting = [((12, False, ""), 2), ((12, True, "car"), 3)]
    handle, _, found = replayed([11, 13], waiting)
    assert found == [(11, 16, None, 4), (11, 16, "car", 5)]
    assert not handle.names["waiting"].map
