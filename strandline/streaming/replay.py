"""Anchored windows of a stream in event time: keyed state with timers on the RocksDB store.

The windows are those of :mod:`strandline.streaming.anchored`, but polls follow the frames' own time: a tick is
taken into its window once the watermark has passed it, whatever order frames arrived in, and a window with frames closes
when the watermark passes its closing tick. So a replay gives the rows of the batch form, over restarts too.

Each access to state is a round trip to the JVM, so a camera's arrivals are appended as one list and have one timer, at their earliest tick;
when it fires all ticks that have passed are taken at once, and the open window and the sums of its labels are read and written once.
More variables can be added by a subclass without losing a checkpoint; ``waiting`` holds what a checkpoint of the earlier form, a variable entry
and a timer per tick, had left to do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strandline.streaming.frames import WINDOW_SECONDS, counted_labels

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSED = "camera_id string, window_start bigint, window_end bigint, label string, total bigint"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs; set it before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class AnchoredWindows(StatefulProcessor):
    """One camera's windows; starts and ends are numbers of ticks of ``tick_ms`` milliseconds."""

    def __init__(self, width: int, tick_ms: int) -> None:
        self.width, self.tick_ms = width, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "start bigint, frames bigint")
        self.sums = handle.getMapState("sums", "label string", "total bigint")
        # is_label tells a frame count from a label whose name is empty
        self.waiting = handle.getMapState("waiting", "tick bigint, is_label boolean, label string", "n bigint")
        self.arrived = handle.getListState("arrived", "tick bigint, is_label boolean, label string, n bigint")

    def _passed(self, tick: int) -> int:
        """The time at which no more frames of a tick can come."""
        return (tick + 1) * self.tick_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            entries = []
            for tick, label, n in zip(batch["tick"].tolist(), batch["label"].tolist(), batch["n"].tolist()):
                is_label = isinstance(label, str)
                entries.append((int(tick), is_label, label if is_label else "", int(n)))
            if entries:
                self.arrived.appendList(entries)
                first = min(e[0] for e in entries) if first is None else min(first, min(e[0] for e in entries))
        if first is not None:
            self.handle.registerTimer(self._passed(first))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        done: dict[int, list] = {}
        later: list[tuple] = []
        for entry in self.arrived.get():
            if self._passed(entry[0]) <= now:
                done.setdefault(entry[0], []).append(entry)
            else:
                later.append(tuple(entry))
        for at, value in list(self.waiting.iterator()):
            if self._passed(at[0]) <= now:
                done.setdefault(at[0], []).append((*at, value[0]))
                self.waiting.removeKey(at)
        self._load()
        out: list[tuple] = []
        for tick in sorted(done):
            self._close(key[0], tick - 1, out)
            for _, is_label, label, n in done[tick]:
                self._count(tick, is_label, label, n)
            start, frames = self.open
            if tick - start >= self.width:  # the closing tick, or the first one after an idle stretch
                out += self._emit(key[0], start, tick)
                self._begin(tick)
        self._close(key[0], now // self.tick_ms - 1, out)
        self._store()
        if done and later:
            self.arrived.put(later)
        elif done:
            self.arrived.clear()
        if later:
            self.handle.registerTimer(self._passed(min(e[0] for e in later)))
        if self.open and self.open[1]:
            self.handle.registerTimer(self._passed(self.open[0] + self.width))
        if out:
            yield pd.DataFrame(out, columns=["camera_id", "window_start", "window_end", "label", "total"])

    def _load(self) -> None:
        self.open = self.window.get()
        self.totals = {label[0]: n[0] for label, n in self.sums.iterator()}
        self.stored = (self.open, dict(self.totals))

    def _store(self) -> None:
        """Write back what has changed since :meth:`_load`."""
        before, totals = self.stored
        if self.open != before:
            self.window.update(self.open)
        if totals.keys() - self.totals.keys():
            self.sums.clear()
            totals = {}
        for label, n in self.totals.items():
            if totals.get(label) != n:
                self.sums.updateValue((label,), (n,))

    def _count(self, tick: int, is_label: bool, label: str, n: int) -> None:
        start, frames = self.open or (tick, 0)
        if is_label:
            self.totals[label] = self.totals.get(label, 0) + n
        self.open = (start, frames + (0 if is_label else n))

    def _close(self, camera: str, upto: int, out: list[tuple]) -> None:
        """Close the open window if it has frames and its closing tick is ``upto`` or before."""
        if self.open and self.open[1] and self.open[0] + self.width <= upto:
            out += self._emit(camera, self.open[0], self.open[0] + self.width)
            self._begin(self.open[0] + self.width)

    def _emit(self, camera: str, start: int, end: int) -> list[tuple]:
        return [(camera, start, end, None, self.open[1]), *((camera, start, end, label, n) for label, n in self.totals.items())]

    def _begin(self, tick: int) -> None:
        self.open, self.totals = (tick, 0), {}

    def close(self) -> None:
        pass


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield batch.groupby(["camera_id", "tick", "label"], dropna=False, as_index=False)["n"].sum()


def anchored_replay(
    frames: DataFrame, width: int = WINDOW_SECONDS, tick: int = 1, delay: str = "0 seconds", processor: type[AnchoredWindows] = AnchoredWindows
) -> DataFrame:
    """Closed windows of a frame stream (camera_id, ts, detections) in long form; a null label counts frames.

    Frames are summed per camera, tick and label inside every input partition, so a busy camera sends its state a few rows a tick.
    """
    use_rocksdb(frames.sparkSession)
    at = F.floor(F.unix_micros("ts") / (tick * 1_000_000)).cast("bigint")
    marked = frames.withWatermark("ts", delay)
    entries = marked.select("camera_id", at.alias("tick"), F.explode(counted_labels("detections")).alias("e"))
    entries = entries.select("camera_id", "tick", "e.label", "e.n")
    summed = entries.mapInPandas(_combine, "camera_id string, tick bigint, label string, n bigint")
    return summed.groupBy("camera_id").transformWithStateInPandas(
        statefulProcessor=processor(max(1, width // tick), tick * 1000), outputStructType=CLOSED, outputMode="Append", timeMode="EventTime"
    )
