"""Exact Jaccard join of word shingles through a tree over count vectors.

A document is its set of distinct shingles. Shingles are hashed into ``GROUPS`` groups, or for large
sets into as many more, by powers of two, that a group holds about ``PER_GROUP``; the counts
per group are the document's point. Points of unlike length meet after folding the longer one. For two points the sum of the smaller coordinates
bounds the overlap of the sets from above, and likewise for rectangles of points (with the larger
corner of each); this is the tree's descent rule.

1. Root: a set's leading coordinates are its n - ceil(0.8 n) + 1 least shingle hashes. Two sets
   that link share one of them (the rest is too small to hold 0.8 of the larger set), so the
   sets under one shingle form a subtree and nothing outside needs to be met.
2. A subtree with one point only is dropped; so copies of one set, being one point, cost nothing.
3. Each subtree's hub (the point that shares most with others) is compared with the others of the subtree: bound
   first, then the sets themselves. Large groups of near copies link up here with one pair per point.
4. Subtrees that still hold points of different components are dealt into blocks of a bounded number of
   points by size class and a hash; blocks of neighbouring sizes meet. Inside a task the points of a block are
   packed by size and by the coordinate that spreads most into leaves, leaves into inner nodes, each with the
   larger corner of its points; pairs of nodes are descended while the bound allows a link, and
   points of the leaves reached are compared one by one, those of one component being skipped.
   a. On the points alone this tells which points have a partner at all; only these go on.
   b. With their sets at hand the same descent's pairs are verified exactly, the likeliest first. What comes out are
      links that join components not joined yet, so their number follows the points and not the pairs.
   A pair meets once: where both points share one of the last ``EARLIER`` subtrees before, it is left to that one.
5. Components of the links by repeated least-neighbour steps.

No pair of sets that link is lost: a link either joins two points already in one component, or its
points meet in step 3 or 4. Sets are told apart by 64-bit hashes of their shingles and of the
set, so a wrong equality has a chance of about pairs compared / 2^64.

Null texts count as empty. Documents without words link with nothing and are their own component.
Rows of equal or null doc_id are separate rows; the component's name is the least non-null doc_id.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import wordhash
from strandline.session import in_small_batches

GROUPS, PER_GROUP, SIZE = 64, 8, 5
NUM, DEN = 80, 100
LEAF, LEAF_SHINGLES = 2048, 1 << 22
NODE, FAN = 64, 8
CLASS = 1.25
EARLIER = 4
MAX_BROADCAST = 500_000
SCHEMA = "doc_id long, n_shingles long, key long, point binary, lead array<long>"
MEETING = "pair long, side int, key long, n long, label long, earlier array<long>, point binary"
_BYTE, _SUM = 255, 1000  # coordinates are cut there to fit 8 bits, and sums of folded ones, so that 64 of these fit 16: bounds only get wider


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat, kind))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    ids = batch.column(0).to_pylist()
    texts = batch.column(1).cast(pa.large_binary())
    for i, doc_id in enumerate(ids):
        yield doc_id, texts[i].as_py() or b""


def _set_key(values: np.ndarray) -> int:
    total = wordhash.mix(values + np.uint64(0x632BE59BD9B4E019)).sum(keepdims=True) + np.uint64(len(values))
    return int(wordhash.mix(total).view(np.int64)[0])


def _counts(values: np.ndarray) -> bytes:
    """Counts in groups whose number is a power of two, ``GROUPS`` at least, one byte each."""
    groups = max(GROUPS, 1 << (max(1, -(-len(values) // PER_GROUP)) - 1).bit_length())
    counts = np.bincount((values & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, _BYTE).astype(np.uint8).tobytes()


def describe(size: int = SIZE, num: int = NUM, den: int = DEN):
    """A mapInArrow function: doc_id, text -> SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, keys, points, leads = [], [], [], [], []
            for doc_id, text in _texts(batch):
                values = wordhash.shingles(wordhash.words(text), size)
                n = len(values)
                ids.append(doc_id)
                counts.append(n)
                keys.append(_set_key(values) if n else None)
                points.append(_counts(values))
                leads.append(values[: n - -(-num * n // den) + 1 if n else 0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(keys, pa.int64()), pa.array(points, pa.binary()), _lists(leads, pa.int64())],
                ["doc_id", "n_shingles", "key", "point", "lead"],
            )

    return run


def sets(size: int = SIZE):
    """A mapInArrow function: doc_id, text -> key, shingles (ascending as unsigned numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = [], []
            for _, text in _texts(batch):
                v = wordhash.shingles(wordhash.words(text), size)
                if len(v):
                    keys.append(_set_key(v))
                    values.append(v.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), _lists(values, pa.int64())], ["key", "shingles"])

    return run


def _folded(raw: list[bytes]) -> np.ndarray:
    """The points as rows of a matrix, longer ones folded to the shortest one's length."""
    sizes = np.array([len(r) for r in raw])
    width = int(sizes.min())
    if sizes.max() == width:
        return np.frombuffer(b"".join(raw), np.uint8).reshape(-1, width).astype(np.uint16)
    out = np.empty((len(raw), width), np.uint16)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        flat = np.frombuffer(b"".join(raw[r] for r in rows.tolist()), np.uint8)
        out[rows] = np.minimum(flat.reshape(len(rows), size // width, width).sum(axis=1, dtype=np.int64), _SUM)
    return out


def bounded(num: int = NUM, den: int = DEN):
    """A mapInArrow function over pairs: a, b, n1, n2, p1, p2 -> the pairs (a, b) whose points allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            total = batch.column("n1").to_numpy() + batch.column("n2").to_numpy()
            one, two = batch.column("p1").to_pylist(), batch.column("p2").to_pylist()
            widths = np.array([min(len(x), len(y)) for x, y in zip(one, two)])
            larger = np.zeros(len(one), np.int64)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width).tolist()
                # the short point of a pair sets the width; a row of that width is put before each side to fold to it
                x = _folded([bytes(width), *(one[i] for i in at)])[1:]
                y = _folded([bytes(width), *(two[i] for i in at)])[1:]
                larger[at] = np.maximum(x, y).sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array((num + den) * larger <= den * total))

    return run


def _pack(points: np.ndarray, n: np.ndarray, rows: np.ndarray, num: int, den: int) -> list[np.ndarray]:
    """``rows`` cut into leaves of neighbours: by size while sizes differ too much to link, then by the coordinate that spreads most."""
    todo, leaves = [rows], []
    while todo:
        part = todo.pop()
        if len(part) <= NODE:
            leaves.append(part)
            continue
        by = n[part]
        if den * by.min() >= num * by.max():
            block = points[part]
            by = block[:, block.var(axis=0).argmax()]
        order, half = np.argsort(by, kind="stable"), len(part) // 2
        todo += [part[order[half:]], part[order[:half]]]
    return leaves


class _Nodes:
    """One level of the tree: the larger corner and the extreme sizes of each node's points."""

    def __init__(self, corner: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.corner, self.least, self.most = corner, least, most

    @classmethod
    def of_leaves(cls, leaves: list[np.ndarray], points: np.ndarray, n: np.ndarray) -> _Nodes:
        return cls(np.stack([points[x].max(axis=0) for x in leaves]), np.array([n[x].min() for x in leaves]), np.array([n[x].max() for x in leaves]))

    def inner(self) -> _Nodes:
        at = np.arange(0, len(self.least), FAN)
        return _Nodes(np.maximum.reduceat(self.corner, at), np.minimum.reduceat(self.least, at), np.maximum.reduceat(self.most, at))

    def may_link(self, i: np.ndarray, other: _Nodes, j: np.ndarray, num: int, den: int) -> np.ndarray:
        """For the node pairs (i, j) whether points below them can link."""
        overlap = np.minimum(self.corner[i], other.corner[j]).sum(axis=1, dtype=np.int64)
        alike = (num * self.least[i] <= den * other.most[j]) & (num * other.least[j] <= den * self.most[i])
        return alike & ((num + den) * overlap >= num * (self.least[i] + other.least[j]))


def _reached(one: _Nodes, two: _Nodes, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that a descent from the inner nodes reaches."""
    top, low = one.inner(), two.inner()
    i, j = (x.ravel() for x in np.indices((len(top.least), len(low.least))))
    ok = top.may_link(i, low, j, num, den)
    spread_i, spread_j = (x.ravel() for x in np.indices((FAN, FAN)))
    i, j = (i[ok][:, None] * FAN + spread_i).ravel(), (j[ok][:, None] * FAN + spread_j).ravel()
    there = (i < len(one.least)) & (j < len(two.least))
    i, j = i[there], j[there]
    ok = one.may_link(i, two, j, num, den)
    return i[ok], j[ok]


def _passing(x: np.ndarray, y: np.ndarray, total: np.ndarray, num: int, den: int) -> np.ndarray:
    """For each point of ``x`` and of ``y`` whether the sum of the larger coordinates allows a link; ``total`` is both sizes' sum."""
    larger = np.zeros(total.shape, np.int64)
    ok = np.ones(total.shape, bool)
    for first in range(0, x.shape[1], GROUPS):
        mine, theirs = x[:, first : first + GROUPS], y[:, first : first + GROUPS]
        if total.size <= NODE * NODE:
            larger += np.maximum(mine[:, None, :], theirs[None, :, :]).sum(axis=2, dtype=np.int64)
        else:
            lanes, step, part = np.ascontiguousarray(theirs.T), np.empty(total.shape, np.uint16), np.zeros(total.shape, np.uint16)
            for lane in range(lanes.shape[0]):
                np.maximum(mine[:, lane, None], lanes[None, lane], out=step)
                np.add(part, step, out=part)
            larger += part
        # the sum of the larger coordinates only grows
        ok = (num + den) * larger <= den * total
        if not ok.any():
            break
    return ok


def _meet(n: np.ndarray, label: np.ndarray, earlier: np.ndarray, points: np.ndarray, side: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one meeting of blocks that pass the bound; side 0 meets side 1, side 2 meets itself."""
    inside = bool((side == 2).any())
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    mine = _pack(points, n, left, num, den)
    theirs = mine if inside else _pack(points, n, right, num, den)
    place = np.empty(len(n), np.int64)  # in the order of the leaves
    place[np.concatenate(mine if inside else mine + theirs)] = np.arange(len(n))
    if len(mine) == len(theirs) == 1:
        meets = [(mine[0], theirs[0])]
    else:
        one = _Nodes.of_leaves(mine, points, n)
        i, j = _reached(one, one if inside else _Nodes.of_leaves(theirs, points, n), num, den)
        if inside:
            i, j = i[i <= j], j[i <= j]
        meets = [(mine[k], np.concatenate([theirs[x] for x in j[i == k].tolist()])) for k in np.unique(i).tolist()]
    out_l, out_r = [left[:0]], [left[:0]]
    for rows, near in meets:
        ok = label[rows][:, None] != label[near][None, :]
        if inside:
            ok &= place[rows][:, None] < place[near][None, :]
        sizes, others = n[rows][:, None], n[near][None, :]
        ok &= den * np.minimum(sizes, others) >= num * np.maximum(sizes, others)
        if not ok.any():
            continue
        ok &= _passing(points[rows], points[near], sizes + others, num, den)
        i, j = np.nonzero(ok)
        i, j = rows[i], near[j]
        one = earlier[i][:, :, None]
        first = ~((one == earlier[j][:, None, :]) & (one != 0)).any(axis=(1, 2))
        out_l.append(i[first])
        out_r.append(j[first])
    return np.concatenate(out_l), np.concatenate(out_r)


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    x, y = (x, y) if len(x) < len(y) else (y, x)
    return int((y.take(np.searchsorted(y, x), mode="clip") == x).sum())


def _joining(key, n, label, i, j, likeness, flat, offsets, num: int, den: int) -> tuple[list[int], list[int]]:
    """Of the pairs (i, j) the links that join labels not joined by the links before; likelier pairs are verified first."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = x = top.get(up, up)
        return x

    a, b = [], []
    order = np.argsort(-likeness, kind="stable")
    for x, y in zip(i[order].tolist(), j[order].tolist()):
        one, two = find(int(label[x])), find(int(label[y]))
        if one != two:
            both = _overlap(flat[offsets[x] : offsets[x + 1]], flat[offsets[y] : offsets[y + 1]])
            if den * both >= num * (int(n[x]) + int(n[y]) - both):
                top[one] = two
                a.append(int(key[x]))
                b.append(int(key[y]))
    return a, b


def _meetings(flush):
    """A mapInArrow function over rows sorted by ``pair``: ``flush`` on the rows of each pair, which may lie in several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pair = batch.column("pair").to_numpy()
            edges = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)]
            for start, end in zip(edges, edges[1:]):
                if held and pair[start] != last:
                    yield from flush(held)
                    held = []
                last = pair[start]
                held.append(batch.slice(start, end - start))
        if held:
            yield from flush(held)

    return run


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def _numbers(rows: pa.RecordBatch):
    """Sizes, labels, subtrees before (a row each), points and sides of a meeting's rows."""
    earlier = rows.column("earlier").flatten().to_numpy().reshape(rows.num_rows, EARLIER)
    n, label, side = (rows.column(c).to_numpy() for c in ("n", "label", "side"))
    return n, label, earlier, _folded(rows.column("point").to_pylist()), side


def with_partners(num: int = NUM, den: int = DEN):
    """A mapInArrow function over the rows of meetings: those that have a partner."""

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _joined(parts)
        i, j = _meet(*_numbers(rows), num, den)
        if len(i):
            yield rows.take(pa.array(np.unique(np.concatenate((i, j)))))

    return _meetings(flush)


def verified(num: int = NUM, den: int = DEN):
    """A mapInArrow function over the rows of meetings and their shingles: links a, b."""

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _joined(parts)
        n, label, earlier, points, side = _numbers(rows)
        i, j = _meet(n, label, earlier, points, side, num, den)
        if not len(i):
            return
        least = [np.minimum(points[i[at : at + 4096]], points[j[at : at + 4096]]).sum(axis=1, dtype=np.int64) for at in range(0, len(i), 4096)]
        shingles = rows.column("shingles")
        flat, offsets = shingles.flatten().to_numpy().view(np.uint64), shingles.offsets.to_numpy() - shingles.offsets[0].as_py()
        a, b = _joining(rows.column("key").to_numpy(), n, label, i, j, np.concatenate(least) / (n[i] + n[j]), flat, offsets, num, den)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return _meetings(flush)


def components(links: DataFrame, stage) -> DataFrame:
    """(node, component) of undirected links (a, b): the least node reachable, by repeated least-neighbour and jump steps."""
    both = stage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    state = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        seen = both.join(state.select(F.col("node").alias("b"), F.col("component").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        near = state.join(seen, state["node"] == seen["a"]).select("node", F.least("component", "c").alias("next"), F.col("component").alias("was"))
        near = stage(near)
        up = near.select(F.col("node").alias("next"), F.col("next").alias("top"))
        after = stage(near.join(up, "next", "left").select("node", F.least("next", F.coalesce("top", "next")).alias("component"), "was"))
        moved = after.where("component != was").limit(1).count()
        state = after.select("node", "component")
        if not moved:
            return state


def _checked(df: DataFrame) -> DataFrame:
    """Broadcast if it is small by count; a shuffle join otherwise."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else df


def _sets(keys: DataFrame, described: DataFrame, docs: DataFrame, stage, size: int) -> DataFrame:
    """key, shingles of the staged ``keys``. Only the texts of these sets are read into sets again."""
    # one document for each set; equal or null ids only bring further sets along, whose keys are not wanted
    ids = described.select("doc_id", "key").join(_checked(keys), "key").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    ids = stage(ids.select("doc_id").distinct())
    again = docs.select(F.col("doc_id").alias("id"), "text")
    again = again.join(_checked(ids), again["id"].eqNullSafe(ids["doc_id"]), "left_semi")
    found = again.mapInArrow(sets(size), "key long, shingles array<long>").join(_checked(keys), "key", "left_semi")
    return stage(found.dropDuplicates(["key"]))


def _star_links(star: DataFrame, described: DataFrame, docs: DataFrame, stage, num: int, den: int, size: int) -> DataFrame:
    """The staged pairs (a, b) of set keys whose sets link."""
    found = _sets(stage(star.select(F.col("a").alias("key")).union(star.select("b")).distinct()), described, docs, stage, size)
    one = found.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    two = found.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    met = star.join(one, "a").join(two, "b").withColumn("o", F.size(F.array_intersect("x", "y")).cast("long"))
    return met.where(den * F.col("o") >= num * (F.size("x") + F.size("y") - F.col("o"))).select("a", "b")


def _release(df: DataFrame) -> None:
    """Let the driver drop what finished steps hold, so that the cleaner deletes their shuffle files now and not at some later time."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def classes(docs: DataFrame, stage, text: str = "text", size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id; sets link when den * intersection >= num * union.

    ``stage(df)`` writes a table to the shared folder and rereads it.
    """
    stage = in_small_batches(stage)
    docs = docs.select("doc_id", F.col(text).alias("text"))
    described = stage(docs.mapInArrow(describe(size, num, den), SCHEMA))
    filled = described.where(F.col("key").isNotNull())
    tokens = filled.select("key", F.explode("lead").alias("token"))
    roots = tokens.groupBy("token").agg(F.min("key").alias("k1"), F.max("key").alias("k2"), F.count("*").alias("c")).where("k1 != k2")
    shared = stage(tokens.join(roots.select("token", "c"), "token").distinct())
    score = stage(shared.groupBy("key").agg(F.sum("c").alias("score")))
    points = filled.select("key", F.col("n_shingles").alias("n"), "point").join(score.select("key"), "key", "left_semi")
    points = stage(points.dropDuplicates(["key"]))

    scored = shared.join(score, "key").select("token", "key", "score")
    hubs = scored.groupBy("token").agg(F.max(F.struct("score", "key")).alias("h")).select("token", F.col("h.key").alias("hub"))
    star = shared.join(hubs, "token").where("key != hub").select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b")).distinct()
    side = lambda key, n, p: points.select(F.col("key").alias(key), F.col("n").alias(n), F.col("point").alias(p))
    star = star.join(side("a", "n1", "p1"), "a").join(side("b", "n2", "p2"), "b").where(den * F.least("n1", "n2") >= num * F.greatest("n1", "n2"))
    star = stage(star.select("a", "b", "n1", "n2", "p1", "p2").mapInArrow(bounded(num, den), "a long, b long"))
    links = stage(_star_links(star, described, docs, stage, num, den, size))

    labels = components(links, stage)
    marked = points.join(labels.select(F.col("node").alias("key"), "component"), "key", "left")
    log_class = F.floor(F.log(F.col("n").cast("double")) / float(np.log(CLASS))).cast("int")
    marked = stage(marked.select("key", "n", F.coalesce("component", "key").alias("label"), log_class.alias("class"), "point"))
    mixed = stage(shared.select("token", "key").join(marked.select("key", "n", "label", "class"), "key"))
    left_over = mixed.groupBy("token").agg(F.count("*").alias("c"), F.min("label").alias("l1"), F.max("label").alias("l2")).where("c > 2 AND l1 != l2")
    mixed = mixed.join(left_over.select("token"), "token")
    # the last subtrees before this one that a point is in; each holds three points or more of different labels too
    before = Window.partitionBy("key").orderBy("token")
    mixed = stage(mixed.withColumn("earlier", F.array(*(F.coalesce(F.lag("token", i).over(before), F.lit(0).cast("long")) for i in range(1, EARLIER + 1)))))
    # blocks: a class of one subtree, in as many parts as its points and their shingles ask for; neighbouring classes meet
    leaves = mixed.groupBy("token", "class").agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.min("label").alias("l1"), F.max("label").alias("l2"))
    leaves = stage(leaves.withColumn("parts", F.expr(f"greatest((c - 1) div {LEAF}, (n - 1) div {LEAF_SHINGLES}) + 1")))
    above = leaves.select("token", (F.col("class") - 1).alias("class"), F.col("parts").alias("parts_above"), F.col("l1").alias("a1"), F.col("l2").alias("a2"))
    below = leaves.select("token", (F.col("class") + 1).alias("class"), F.col("parts").alias("parts_below"), F.col("l1").alias("b1"), F.col("l2").alias("b2"))
    plan = leaves.join(above, ["token", "class"], "left").join(below, ["token", "class"], "left")
    differ = lambda x, y: f"NOT ({x}1 = {x}2 AND {y}1 = {y}2 AND {x}1 = {y}1)"
    plan = plan.select(
        "token", "class", "parts",
        F.expr("l1 != l2").alias("self"),
        F.expr(f"CASE WHEN parts_above IS NOT NULL AND {differ('l', 'a')} THEN parts_above ELSE 0 END").alias("up"),
        F.expr(f"CASE WHEN parts_below IS NOT NULL AND {differ('l', 'b')} THEN parts_below ELSE 0 END").alias("down"),
    ).where("self OR up > 0 OR down > 0")
    rows = mixed.join(plan, ["token", "class"]).withColumn("part", F.expr("pmod(xxhash64(key), parts)"))
    name = "named_struct('c', {c}, 'd', {d}, 'i', {i}, 'j', {j}, 'side', {side})"
    same = "transform(sequence(0L, parts - 1), k -> " + name.format(c="class", d="class", i="least(part, k)", j="greatest(part, k)", side="CASE WHEN k = part THEN 2 WHEN part < k THEN 0 ELSE 1 END") + ")"
    over = "transform(sequence(0L, up - 1), k -> " + name.format(c="class", d="class + 1", i="part", j="k", side="0") + ")"
    under = "transform(sequence(0L, down - 1), k -> " + name.format(c="class - 1", d="class", i="k", j="part", side="1") + ")"
    none = "cast(array() AS array<struct<c:int,d:int,i:bigint,j:bigint,side:int>>)"
    meets = f"concat(CASE WHEN self THEN {same} ELSE {none} END, CASE WHEN up > 0 THEN {over} ELSE {none} END, CASE WHEN down > 0 THEN {under} ELSE {none} END)"
    rows = rows.select("token", "key", "n", "label", "earlier", F.explode(F.expr(meets)).alias("m"))
    rows = rows.select(F.xxhash64("token", "m.c", "m.d", "m.i", "m.j").alias("pair"), "m.side", "key", "n", "label", "earlier")
    rows = rows.join(marked.select("key", "point"), "key").select("pair", "side", "key", "n", "label", "earlier", "point")
    met = stage(rows.repartition("pair").sortWithinPartitions("pair").mapInArrow(with_partners(num, den), MEETING))
    found = _sets(stage(met.select("key").distinct()), described, docs, stage, size)
    rows = met.join(found, "key").repartition("pair").sortWithinPartitions("pair")
    links = stage(links.union(rows.mapInArrow(verified(num, den), "a long, b long")))
    _release(docs)

    labels = components(links, stage)
    by_key = filled.groupBy("key").agg(F.min("doc_id").alias("least")).join(labels.select(F.col("node").alias("key"), "component"), "key", "left")
    by_key = stage(by_key.select("key", "least", F.coalesce("component", "key").alias("label")))
    named = by_key.groupBy("label").agg(F.min("least").alias("component_id"))
    named = by_key.join(named, "label").select("key", "component_id")
    out = filled.select("doc_id", "n_shingles", "key").join(named, "key").select("doc_id", "n_shingles", "component_id")
    return out.union(described.where(F.col("key").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, stage, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that have a near duplicate of a lesser doc_id (nulls last), or an earlier equal one.

    Rows are told apart by a number of their own; all columns stay. Few rows go, so their numbers are broadcast where they
    are counted to be few, and otherwise joined.
    """
    numbered = stage(docs.select(F.struct("*").alias("r"), F.monotonically_increasing_id().alias("i")))
    found = classes(numbered.select(F.col("i").alias("doc_id"), F.col(f"r.{text}").alias("text")), stage)
    found = found.select(F.col("doc_id").alias("i"), F.col("component_id").alias("c"))
    ranked = stage(found.join(numbered.select("i", F.col("r.doc_id").alias("d")), "i"))
    order = F.struct(F.col("d").isNull(), "d", "i")
    first = ranked.groupBy("c").agg(F.min(order).alias("o"), F.count("*").alias("n")).where("n > 1").select("c", F.col("o.i").alias("first"))
    gone = stage(ranked.join(first, "c").where("i != first").select("i"))
    return numbered.join(_checked(gone), "i", "left_anti").select("r.*")
