"""Windows anchored at a camera's own first frame: stateful stream and its batch twin.

A window opens with the camera's first frame and closes at the first poll at
least ``width`` later if it saw a frame; the next one starts at the closing
time. After an idle stretch the start is stale, so the next frame closes a window
at once. Polls come every tick (one second unless told otherwise), and frames
polled at the closing tick belong to the closing window.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandline.session import materialize
from strandline.streaming.frames import WINDOW_SECONDS, averages, counted_labels

BLOCK_TICKS = 86_400


# --- batch twin -------------------------------------------------------------


def _walk(ticks: list[int], end: int, start: int | None, pending: bool, width: int) -> tuple[list[int], int, bool]:
    """Follow the windows of one camera through one block of sorted frame ticks.

    Returns the window start of every tick and the (start, pending) left at ``end``.
    """
    owner: list[int] = []
    i, n = 0, len(ticks)
    if start is None:
        start, pending = ticks[0], True
    while True:
        close = start + width
        j = bisect_right(ticks, close, i)
        if pending or j > i:
            owner.extend([start] * (j - i))
            i = j
            if close >= end:
                return owner, start, True
            start, pending = close, False
        elif close >= end or i == n:
            return owner, start, False
        else:
            owner.append(start)
            start = ticks[i]
            i += 1


def _exits(ticks: list[int], begin: int, end: int, width: int) -> tuple[list[int], list[bool]]:
    """State at ``end`` for every state a block can be entered in.

    Entry 0: no window yet; 1: stale start; 2 + 2 * (o - 1) + p: started o ticks
    before ``begin``, p = has frames. Runs meet quickly, so where a run goes from
    each closing tick on is remembered.
    """
    known: dict[int, tuple[int, bool]] = {}

    def follow(start: int) -> tuple[int, bool]:
        path = []
        while start not in known:
            path.append(start)
            close = start + width
            i = bisect_right(ticks, start)
            if i < len(ticks) and ticks[i] <= close:
                if close >= end:
                    known[start] = (start, True)
                else:
                    start = close
            elif close >= end or i == len(ticks):
                known[start] = (start, False)
            else:
                start = ticks[i]
        for seen in path:
            known[seen] = known[start]
        return known[start]

    def enter(start: int, pending: bool) -> tuple[int, bool]:
        # A window that already has frames closes on time, with or without more.
        if pending:
            return (start, True) if start + width >= end else follow(start + width)
        return follow(start)

    left = [enter(ticks[0], True), follow(begin - width - 1)]
    left += [enter(begin - o, bool(p)) for o in range(1, width + 1) for p in (0, 1)]
    return [s for s, _ in left], [p for _, p in left]


def _chain(blocks: list[dict], block_ticks: int, width: int) -> list[tuple[int, int | None, bool]]:
    """Entry state (block, start, has frames) of each block of one camera, in time order."""
    start, pending, out = None, False, []
    for row in sorted(blocks, key=lambda r: r["block"]):
        begin = int(row["block"]) * block_ticks
        if start is None:
            entry = 0
        else:
            if pending and start + width < begin:
                start, pending = start + width, False
            entry = 1 if begin - start > width else 2 + 2 * (begin - start - 1) + int(pending)
        out.append((int(row["block"]), start, pending))
        start, pending = int(row["starts"][entry]), bool(row["open"][entry])
    return out


def anchored_assignment(
    ticks: DataFrame, camera: str = "camera_id", width: int = WINDOW_SECONDS, block_ticks: int = BLOCK_TICKS
) -> DataFrame:
    """``(camera, tick, window_start)`` for distinct frame ticks.

    Only a block's entry state depends on its past, and there are few of those:
    a start at most ``width`` ticks back, with or without frames, a stale start,
    or none. Pass 1 maps every entry state of each (camera, block) to its exit;
    pass 2 follows these maps, one entry per camera and block; pass 3 assigns.
    The lists are bounded by time, not by frames: ``block_ticks`` ticks per block
    and one map per block of the recorded period.
    """
    block_ticks = max(block_ticks, width)
    block = F.floor(F.col("tick") / block_ticks).cast("bigint")
    blocks = (
        ticks.select(F.col(camera).alias("camera"), "tick", block.alias("block"))
        .groupBy("camera", "block")
        .agg(F.array_sort(F.collect_set("tick")).alias("ticks"))
    )

    @F.pandas_udf("starts array<bigint>, open array<boolean>")
    def exits(block: pd.Series, ticks: pd.Series) -> pd.DataFrame:
        rows = [_exits(t.tolist(), b * block_ticks, (b + 1) * block_ticks, width) for b, t in zip(block.tolist(), ticks)]
        return pd.DataFrame(rows, columns=["starts", "open"])

    @F.pandas_udf("array<struct<block:bigint,start:bigint,pending:boolean>>")
    def chain(maps: pd.Series) -> pd.Series:
        names = ("block", "start", "pending")
        return pd.Series([[dict(zip(names, r)) for r in _chain(list(m), block_ticks, width)] for m in maps])

    @F.pandas_udf("array<bigint>")
    def assign(block: pd.Series, ticks: pd.Series, start: pd.Series, pending: pd.Series) -> pd.Series:
        out = []
        for b, t, s, p in zip(block.tolist(), ticks, start, pending):
            first = None if pd.isna(s) else int(s)
            out.append(_walk(t.tolist(), (b + 1) * block_ticks, first, bool(p), width)[0])
        return pd.Series(out)

    maps = blocks.select("camera", "block", exits("block", "ticks").alias("m")).select("camera", "block", "m.*")
    states = (
        maps.groupBy("camera")
        .agg(F.collect_list(F.struct("block", "starts", "open")).alias("maps"))
        .select("camera", F.inline_outer(chain("maps")))
        .filter("block is not null")
    )
    owners = blocks.join(states, ["camera", "block"]).select(
        "camera", F.arrays_zip("ticks", assign("block", "ticks", "start", "pending").alias("owner")).alias("z")
    )
    # Outer generators: the optimizer would run the functions twice for a non-empty check.
    out = owners.select("camera", F.inline_outer("z").alias("tick", "window_start")).filter("tick is not null")
    return out.withColumnRenamed("camera", camera)


def _epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970; a timestamp without zone counts as UTC in any session zone."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(ts))
    return F.unix_micros(ts)


def anchored_windows(
    df: DataFrame,
    ts: str = "ts",
    camera: str = "camera_id",
    detections: str = "detections",
    width: int = WINDOW_SECONDS,
    tick: int = 1,
    block_ticks: int = BLOCK_TICKS,
    keep_open: bool = False,
) -> DataFrame:
    """Per-label averages of anchored windows over a table; starts and ends in ticks.

    Frames are summed per camera, tick and label before anything is grouped by
    camera. A window not yet closed at the last tick of the data is left out
    unless ``keep_open``.
    """
    steps = max(1, width // tick)
    at = F.floor(_epoch_micros(df, ts) / (tick * 1_000_000)).cast("bigint")
    entries = df.select(F.col(camera), at.alias("tick"), F.explode(counted_labels(detections)).alias("e"))
    totals = entries.groupBy(camera, "tick", F.col("e.label").alias("label")).agg(F.sum("e.n").alias("total"))
    # Read three times below; written once so the frames are scanned and summed once.
    totals = materialize(totals, "ticks")
    frames = totals.filter("label is null").select(camera, "tick")
    owners = anchored_assignment(frames, camera, steps, block_ticks)
    # A window closes on time, or with the one late tick that ended an idle stretch.
    end = F.greatest(F.col("tick"), F.col("window_start") + steps).alias("window_end")
    sums = totals.join(owners, [camera, "tick"]).groupBy(camera, "window_start", end, "label").agg(F.sum("total").alias("total"))
    if not keep_open:
        last = frames.agg(F.max("tick")).first()[0]
        sums = sums.filter(F.col("window_end") <= F.lit(last))
    return averages(sums, camera, keep=["window_end"])


# --- stateful stream --------------------------------------------------------

_STATE = "start double, frames bigint, labels array<string>, totals array<bigint>"
_OUT = "camera_id string, start_ms bigint, end_ms bigint, label string, frames bigint, total bigint"


def advance(state: tuple | None, now: float, frames: int, counts: dict[str, int], width: float):
    """One poll of one camera: (new state, closed window or None).

    State is (start, frames, counts); the closed window is (start, frames, counts).
    """
    start, had, sums = state if state is not None else (now, 0, {})
    sums = dict(sums)
    for label, n in counts.items():
        sums[label] = sums.get(label, 0) + n
    total = had + frames
    if total > 0 and now - start >= width:
        return (now, 0, {}), (start, total, sums)
    return (start, total, sums), None


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield batch.groupby(["camera_id", "label"], dropna=False, as_index=False)["n"].sum()


def anchored_stream(frames: DataFrame, width: float = WINDOW_SECONDS) -> DataFrame:
    """Closed windows of a frame stream in processing time, long form.

    Each micro-batch is a poll. Frames are summed inside every input partition
    before the shuffle, so a busy camera sends a few rows per batch to its state;
    an idle camera's open window is closed by its timer.
    """
    entries = frames.select("camera_id", F.explode(counted_labels("detections")).alias("e")).select("camera_id", "e.label", "e.n")
    summed = entries.mapInPandas(_combine, "camera_id string, label string, n bigint")

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs() / 1000.0
        seen, counts = 0, {}
        for batch in batches:
            for label, n in batch[["label", "n"]].itertuples(index=False):
                if label is None or label != label:
                    seen += int(n)
                else:
                    counts[label] = counts.get(label, 0) + int(n)
        before = None
        if state.exists:
            start, had, labels, totals = state.get
            before = (start, had, dict(zip(labels or [], totals or [])))
        (start, total, sums), closed = advance(before, now, seen, counts, width)
        state.update((start, total, list(sums), [int(v) for v in sums.values()]))
        if total > 0:
            state.setTimeoutDuration(max(1, int((start + width - now) * 1000)))
        if closed:
            began, total, sums = closed
            head = (key[0], round(began * 1000), round(now * 1000))
            rows = [(*head, None, total, total)] + [(*head, label, total, n) for label, n in sums.items()]
            yield pd.DataFrame(rows, columns=["camera_id", "start_ms", "end_ms", "label", "frames", "total"])

    closed = summed.groupBy("camera_id").applyInPandasWithState(
        step, _OUT, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return closed.select(
        "camera_id",
        F.timestamp_millis("start_ms").alias("window_start"),
        F.timestamp_millis("end_ms").alias("window_end"),
        "label",
        "frames",
        "total",
    )
