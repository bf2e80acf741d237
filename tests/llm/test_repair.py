"""Conversation repair against a plain search over all edit sequences by cost, then audit."""

import hashlib
import random
import re
from heapq import heappop, heappush
from zlib import crc32

import pytest

from strandline.llm import queries, repair
from tests.conftest import SF

NAME = {"u": "user", "a": "assistant"}


def best(rows):
    """(cost, audit, output) by one heap over (cost, audit): rows are (role, text, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        nxt = "a" if last == "u" else "u"
        heappush(heap, (cost + 3, audit + "I", i, nxt, (*out, (NAME[nxt], ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                heappush(heap, (cost + 3 + more, audit + "R", i + 1, nxt, (*out, (NAME[nxt], text))))
                if role[:1] == nxt or role[:1] == "s" and last == "":
                    heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, (role, text))))
    raise AssertionError


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return out


def result(conv, turned):
    """The expected row for (turn, role, text) after damage."""
    turned = sorted(turned, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    rows = faults([r[1:] for r in turned])
    turns = [t for t, *_ in turned if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [sum(f == k for *_, f in rows) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = best(rows)
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damaged(rows):
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = convs.setdefault(conv, [])
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        kept += [(turn, "user" if k == 4 else role, text)] * (k != 0) * (1 + (k == 3))
    return convs


def plain(rows):
    return sorted((result(c, r) for c, r in damaged(rows).items()), key=str)


def run(df, stage):
    return sorted((tuple(r) for r in repair.repair(repair.damage(df), df, stage).collect()), key=str)


def random_rows(seed, convs=120, longest=12):
    rng = random.Random(seed)
    out = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None, "unit", "User"))
            text = rng.choice(("Hello.", "Well?", "No end", "", " \n", "Same.", "Fine!\t", None, "x" * 50, "é.", "a.b"))
            out.append((c, rng.choice((t, t, t + 3, None)), role, text))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_plain(seed):
    rng = random.Random(seed)
    for _ in range(400):
        rows = [(rng.choice(("user", "assistant", "system", "tool", "")), "", rng.choice(("", "", "", "blank", "truncated"))) for _ in range(rng.randrange(1, 14))]
        codes = [(r[:1], {"": repair.NONE, "blank": repair.BLANK, "truncated": repair.TRUNCATED}[f]) for r, _, f in rows]
        cost, audit, state = repair.cheapest(codes, repair.BEGIN, {s: 3 * len(t) for s, t in enumerate(repair.TAIL)})
        assert (cost, audit + repair.TAIL[state]) == best(rows)[:2]


def test_random_conversations(spark, stage):
    rows = random_rows(5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert run(df, stage) == plain(rows)


@pytest.mark.parametrize("segment", [1, 2, 5])
def test_segments(spark, stage, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    monkeypatch.setattr(repair.solve_segments, "__defaults__", (segment,))
    rows = random_rows(segment, convs=60, longest=25)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(4), stage) == plain(rows)


def test_edge_rows(spark, stage):
    rows = [(None, 0, "user", "Hi."), (None, None, "assistant", "Yes."), (1, None, None, None), (2, 0, "user", "Q?"), (2, 0, "user", "Q?"), (2, 1, "assistant", "A."),
            (3, 5, "user", "long " * 50_000 + "."), (3, 9, "assistant", "fine.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", pos string, fault int")
    assert run(df, stage) == plain(rows)
    assert run(df.limit(0), stage) == []
    # a conversation whose rows are all dropped
    gone = next(c for c in range(10, 1000) if crc32(f"{c}:0".encode()) % 20 == 0)
    got = run(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA), stage)
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in queries.queries()["op12_conversation_repair"](spark, SF).collect()), key=str)
    assert got == plain(rows)
