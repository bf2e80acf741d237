"""Repair of conversation structure by cheapest edits, found with bidirectional Dijkstra over the edit lattice.

A conversation's rows, by turn (nulls first; equal turns by role, then text, then copy), are to give role initials
``(s?(ua)+)?``. A lattice node is (rows consumed, state): nothing yet, after s, after u, after a. Edits and costs:

    D delete 4; I insert an empty user or assistant row 3; K keep 0; R change the role to user or assistant 3
    blank and duplicate rows can only be deleted; a truncated row that stays adds 3

The target role of I and R follows from the state, so a path is named by its initials, the audit. Forward and reverse heaps
advance until the sum of their least keys passes the best meeting, which leaves every crossing of equal cost
settled on both sides; the least audit is then read off by taking, at each node, the least initial that
stays on a cheapest path.

Long conversations are cut into segments of ``SEGMENT`` rows. A segment is solved for each state it can begin and end in, in
any task; the segments of a conversation are then joined by their costs alone, least audit first (paths
over the same rows that end in an edit of a row are never prefixes of one another, so they can be compared segment by segment). No task
holds the texts of a conversation: they pass once, sorted, under the finished audit. What grows
with a conversation in one task is its audit, one byte a row.

Null roles and texts are read as one space, null conv_id and turn likewise where the damage is drawn; rows of null
conv_id form a conversation. A row's initial is its role's first character, so an empty role can be kept nowhere.
A conversation without rows has zeros, an empty audit and the hash of nothing. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 4096
DELETE, INSERT, REROLE, COMPLETE = 4, 3, 3, 3
SPACES = " \t\n\x0b\x0c\r"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: state after an inserted or changed row, and what closes a conversation that ends in a state
NEXT = (USER, USER, ASSISTANT, USER)
TAIL = ("", "II", "I", "")
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP = {("s", BEGIN): SYSTEM, ("u", BEGIN): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
RESULT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", cost long, audit string, repaired_sha256 string"


def _after(rows: list[tuple[str, int]], i: int, s: int) -> list[tuple[str, int, int, int]]:
    """Edits from node (i, s), least initial first: initial, cost, next node's place and state. No inserts behind the last row."""
    if i == len(rows):
        return []
    initial, fault = rows[i]
    out = [("D", DELETE, i + 1, s), ("I", INSERT, i, NEXT[s])]
    if fault in (NONE, TRUNCATED):
        more = COMPLETE if fault == TRUNCATED else 0
        if (kept := KEEP.get((initial, s))) is not None:
            out.append(("K", more, i + 1, kept))
        out.append(("R", REROLE + more, i + 1, NEXT[s]))
    return out


def _before(rows: list[tuple[str, int]], i: int, s: int) -> list[tuple[int, int, int]]:
    """Edits into node (i, s): cost, previous node's place and state."""
    out = [(INSERT, i, p) for p in range(4) if NEXT[p] == s] if i < len(rows) else []
    if i:
        initial, fault = rows[i - 1]
        out.append((DELETE, i - 1, s))
        if fault in (NONE, TRUNCATED):
            more = COMPLETE if fault == TRUNCATED else 0
            out += [(more, i - 1, p) for p in range(4) if KEEP.get((initial, p)) == s]
            out += [(REROLE + more, i - 1, p) for p in range(4) if NEXT[p] == s]
    return out


def cheapest(rows: list[tuple[str, int]], begin: int, ends: dict[int, int]) -> tuple[int, str, int] | None:
    """Cost, least audit and final state from ``begin`` over all rows to a state of ``ends`` (state: cost of ending there)."""
    n, start = len(rows), (0, begin)
    fore, back = {start: 0}, {(n, s): c for s, c in ends.items()}
    fore_heap, back_heap = [(0, start)], sorted((c, x) for x, c in back.items())
    fore_done, back_done = set(), set()
    best = back.get(start, float("inf"))
    first = True
    while (fore_heap or back_heap) and (first or (fore_heap[0][0] if fore_heap else float("inf")) + (back_heap[0][0] if back_heap else float("inf")) <= best):
        # the start is settled first, then the side whose least key is smaller moves
        if first or (fore_heap and (not back_heap or fore_heap[0][0] <= back_heap[0][0])):
            first = False
            d, x = heappop(fore_heap)
            if x in fore_done:
                continue
            fore_done.add(x)
            for _, c, i, s in _after(rows, *x):
                y, e = (i, s), d + c
                if e < fore.get(y, float("inf")):
                    fore[y] = e
                    heappush(fore_heap, (e, y))
                if y in back:
                    best = min(best, e + back[y])
        else:
            d, x = heappop(back_heap)
            if x in back_done:
                continue
            back_done.add(x)
            for c, i, s in _before(rows, *x):
                y, e = (i, s), d + c
                if e < back.get(y, float("inf")):
                    back[y] = e
                    heappush(back_heap, (e, y))
                if y in fore:
                    best = min(best, e + fore[y])
    if best == float("inf"):
        return None
    # nodes settled forwards from which a cheapest path crosses over: the crossings, then what leads to them
    crossing = [
        x for x in fore_done
        if (x[0] == n and fore[x] + ends.get(x[1], best + 1) == best) or (x in back_done and fore[x] + back[x] == best)
        or any((i, s) in back_done and fore[x] + c + back[i, s] == best for _, c, i, s in _after(rows, *x))
    ]
    leads = set(crossing)
    while crossing:
        x = crossing.pop()
        for c, i, s in _before(rows, *x):
            if (i, s) in fore_done and (i, s) not in leads and fore[i, s] + c == fore[x]:
                leads.add((i, s))
                crossing.append((i, s))
    audit, x, spent = [], start, 0
    while x[0] < n:
        for label, c, i, s in _after(rows, *x):
            y = (i, s)
            if (y in back_done and spent + c + back[y] == best) or (y in leads and fore[y] == spent + c):
                audit.append(label)
                x, spent = y, spent + c
                break
    return best, "".join(audit), x[1]


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(key, rows) of runs of rows that agree in their first ``keys`` columns; rows are read as they are asked for."""

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    source = rows()
    held = next(source, None)
    while held is not None:
        key = held[:keys]

        def run():
            nonlocal held
            while held is not None and held[:keys] == key:
                row, held = held, None
                yield row
                held = next(source, None)

        group = run()
        yield key, group
        for _ in group:
            pass


def solve_segments(segment: int = SEGMENT):
    """A mapInArrow function over rows sorted by conv_id, seg, pos: conv_id, seg, pos, initial, fault -> SEGMENTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (conv, seg), group in _grouped(batches, 2):
            rows = [(initial, fault) for *_, initial, fault in group]
            if seg == 0 and len(rows) < segment:
                cost, audit, state = cheapest(rows, BEGIN, {s: INSERT * len(t) for s, t in enumerate(TAIL)})
                out.append((conv, 0, seg, True, [cost], None))
                out.append((conv, 1, seg, True, None, [audit + TAIL[state]]))
            else:
                found = [cheapest(rows, a, {b: 0}) if seg or a == BEGIN else None for a in range(4) for b in range(4)]
                out.append((conv, 0, seg, False, [f[0] if f else None for f in found], None))
                out.append((conv, 1, seg, False, None, [f[1] if f else None for f in found]))
            if len(out) >= 500 or len(rows) == segment:
                yield _batch(out, SEGMENTS)
                out = []
        if out:
            yield _batch(out, SEGMENTS)

    return run


SEGMENTS = pa.schema([("conv_id", pa.int64()), ("kind", pa.int32()), ("seg", pa.int64()), ("whole", pa.bool_()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
JOINED = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conv_id, kind, seg: SEGMENTS -> conv_id, cost, audit. All costs of a conversation come before its audits."""
    out: list[tuple] = []
    for (conv,), group in _grouped(batches, 1):
        costs, ends, pieces, state, spent, total = [], [], [], BEGIN, 0, 0
        for _, kind, seg, whole, cost, audits in group:
            if whole:
                total = cost[0] if kind == 0 else total
                pieces += audits or ()
            elif kind == 0:
                costs.append(cost)
            else:
                if not ends:  # cost to the end from each state before each segment
                    ends = [[INSERT * len(t) for t in TAIL]]
                    for matrix in reversed(costs):
                        ends.append([min((c + e for c, e in zip(matrix[4 * a : 4 * a + 4], ends[-1]) if c is not None and e is not None), default=None) for a in range(4)])
                    ends.reverse()
                    total = ends[0][BEGIN]
                at = len(pieces)
                fits = [b for b in range(4) if (c := costs[at][4 * state + b]) is not None and ends[at + 1][b] is not None and spent + c + ends[at + 1][b] == total]
                chosen = min(fits, key=lambda b: audits[4 * state + b])
                pieces.append(audits[4 * state + chosen])
                spent += costs[at][4 * state + chosen]
                state = chosen
        out.append((conv, total, "".join(pieces) + (TAIL[state] if costs else "")))
        if len(out) >= 500 or costs:
            yield _batch(out, JOINED)
            out = []
    if out:
        yield _batch(out, JOINED)


def _apply(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The rows (role, text) of a conversation after its edits."""
    state, at = BEGIN, 0

    def inserted():
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state, at = NEXT[state], at + 1
            yield ROLE[state], ""

    for role, text in rows:
        yield from inserted()
        label, at = audit[at], at + 1
        if label == "R":
            state = NEXT[state]
            yield ROLE[state], text
        elif label == "K":
            state = KEEP[role[:1], state]
            yield role, text
    yield from inserted()


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conv_id, pos, the first with the counts, cost and audit -> RESULT."""
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in (*COUNTS, "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    out: list[tuple] = []
    for (conv,), group in _grouped(batches, 1):
        _, _, _, _, *counts, cost, audit = next(group)
        digest, gap = hashlib.sha256(), b""
        for role, text in _apply(audit, ((r, t) for _, _, r, t, *_ in group)):
            digest.update(gap + f"{role}:{text}".encode())
            gap = b"\n"
        out.append((conv, *counts, cost, audit, digest.hexdigest()))
        if len(out) >= 500:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def damage(turns: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text with the stated faults, drawn by crc32 of ``conv_id:turn``."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), (F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20).alias("k"))
    text = F.expr("CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END")
    rows = rows.where("k != 0").select("conv_id", "turn", F.expr("IF(k = 4, 'user', role)").alias("role"), text.alias("text"), "k")
    return rows.withColumn("copy", F.explode(F.expr("IF(k = 3, array(0, 1), array(0))"))).select("conv_id", "turn", "role", "text")


def mark(rows: DataFrame) -> DataFrame:
    """Rows with their place, segment, initial and first fault, and what the counts need; one shuffle by conv_id."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.select("conv_id", "turn", "role", "text").repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text", "nth")
    rows = rows.withColumn("nth", F.row_number().over(same))
    rows = rows.select("*", F.row_number().over(order).cast("long").alias("pos"), F.lag("turn").over(order).alias("turn0"), F.left("role", F.lit(1)).alias("initial"))
    rows = rows.withColumn("initial0", F.lag("initial").over(order)).withColumn("bare", bare)
    fault = F.when(F.col("bare") == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(~F.right("bare", F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    return rows.select(
        "conv_id", "pos", F.expr(f"(pos - 1) div {SEGMENT}").alias("seg"), "turn", "role", "text", "initial", fault.alias("fault"),
        F.expr("turn IS NOT NULL AND NOT turn <=> turn0").alias("new_turn"),
        F.expr("pos > 1 AND concat(initial0, initial) NOT IN ('su', 'ua', 'au')").alias("illegal"),
    )


def repair(rows: DataFrame, conversations: DataFrame, stage) -> DataFrame:
    """One row of RESULT for every conv_id of ``conversations``, of its rows (conv_id, turn, role, text) in ``rows``.

    ``stage(df)`` writes a table to the shared folder and rereads it.
    """
    marked = stage(mark(rows))
    segments = marked.select("conv_id", "seg", "pos", "initial", "fault").repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos")
    segments = segments.mapInArrow(solve_segments(), "conv_id long, kind int, seg long, whole boolean, costs array<long>, audits array<string>")
    joined = segments.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "seg").mapInArrow(join_segments, "conv_id long, cost long, audit string")

    ones = lambda cond: F.sum(F.when(F.expr(cond), 1).otherwise(0))
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - ones("new_turn"), F.lit(0)).alias("gaps"),
        *(ones(f"fault = {f}").alias(c) for c, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))),
        ones("illegal").alias("illegal"),
    )
    parts = counts.unionByName(joined, allowMissingColumns=True).unionByName(conversations.select("conv_id").distinct(), allowMissingColumns=True)
    heads = parts.groupBy("conv_id").agg(*(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in (*COUNTS, "cost")), F.coalesce(F.max("audit"), F.lit("")).alias("audit"))
    heads = heads.withColumn("pos", F.lit(0).cast("long"))
    stream = heads.unionByName(marked.select("conv_id", "pos", "role", "text"), allowMissingColumns=True)
    stream = stream.select("conv_id", "pos", "role", "text", *COUNTS, "cost", "audit").repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return stream.mapInArrow(finish, RESULT)
