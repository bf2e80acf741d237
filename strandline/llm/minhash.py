"""MinHash near-duplicate groups with sequential Bayesian verification.

A document is its set of distinct word shingles; equal sets are one point from the start. Each set has
``HASHES`` least values under as many hash functions, 16 bits of each. Two sets agree in one of
them with a probability equal to their Jaccard similarity.

1. Bands of ``ROWS`` values name buckets; sets that share a bucket are candidates. A pair at the
   threshold of 0.85 shares none of the ``BANDS`` buckets with a probability of (1 - 0.85^5)^26, about 2e-7.
2. Verification of a pair goes through the signature in batches of ``BATCH`` values. With a uniform
   prior, m agreements among n values give P(similarity >= t) = P(Binomial(n + 1, t) <= m); the
   pair is dropped as soon as this falls below ``MISS``. Nothing is accepted by the signature: what
   stays is compared on the full sets.
3. Pairs are not listed per bucket, since only links that join different components matter:
   a. each set meets the hub of each of its buckets (the set that shares most buckets with others); pairs
      that pass the batches are compared on their sets,
   b. in buckets that still hold several components, tasks take the sets in blocks of bounded size, run the
      batches over the pairs of different components, each under its first common bucket only, compare the
      likeliest survivors first on their full sets, and emit the links that join components not joined yet.
4. The component of a document is the least doc_id reachable by links.

A link is lost only where banding or the batches miss it and no other path joins its ends. Sets are told apart by 64-bit
hashes of their shingles and of the set.

Null texts count as empty. Documents without words link with nothing and are their own component. Rows of equal
or null doc_id are separate rows; a component is named by its least non-null doc_id. Rows with null
doc_id alone in a component have a null component. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import wordhash
from strandline.llm.jaccard import components

SIZE, NUM, DEN = 5, 85, 100
BANDS, ROWS = 26, 5
BATCH, HASHES = 32, 192
MISS = 1e-6
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
SCHEMA = "doc_id long, n_shingles long, key long, bands array<long>, sig binary, shingles array<long>"

_RNG = np.random.Generator(np.random.PCG64(11))
_MUL = _RNG.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)


def signature(values: np.ndarray) -> np.ndarray:
    """16 bits of the least value of a set under each hash function."""
    words = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(words), 1024):
        part = (words[at : at + 1024, None] ^ _ADD) * _MUL
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(least, part.min(axis=0), out=least)
    # the low bits of a minimum are as even as those of any value
    return (least & np.uint32(0xFFFF)).astype(np.uint16)


def band_names(sig: np.ndarray) -> np.ndarray:
    """One 64-bit name per band, the band's number included; ``sig`` holds a signature per row."""
    rows = sig[:, : BANDS * ROWS].reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        total = wordhash.mix(total * np.uint64(0xD1342543DE82EF95) + rows[:, :, i])
    return total.view(np.int64)


@lru_cache
def least_matches(num: int, den: int, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(values compared, least agreements to go on) after each batch."""
    t = num / den
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return tuple(out)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat, pa.int64()))


def describe(size: int = SIZE):
    """A mapInArrow function: doc_id, text -> SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            for at in range(0, batch.num_rows, 500):
                values = [wordhash.shingles(wordhash.words(t.as_py() or b""), size) for t in texts.slice(at, 500)]
                sigs = [signature(v) if len(v) else None for v in values]
                keys = [int(wordhash.mix(wordhash.mix(v).sum(keepdims=True) + np.uint64(len(v))).view(np.int64)[0]) if len(v) else None for v in values]
                names = [band_names(s[None])[0] if s is not None else np.empty(0, np.int64) for s in sigs]
                columns = [
                    ids.slice(at, 500).cast(pa.int64()), pa.array([len(v) for v in values], pa.int64()), pa.array(keys, pa.int64()), _lists(names),
                    pa.array([s.tobytes() if s is not None else None for s in sigs], pa.binary()), _lists([v.view(np.int64) for v in values]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "key", "bands", "sig", "shingles"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), HASHES)


def likely(num: int = NUM, den: int = DEN):
    """A mapInArrow function over pairs: a, b, sa, sb -> the pairs (a, b) that pass every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch.column("sa")), _matrix(batch.column("sb"))
            at, same, done = np.arange(len(x)), np.zeros(len(x), np.int64), 0
            for n, least in least_matches(num, den):
                same = same + (x[at, done:n] == y[at, done:n]).sum(axis=1)
                at, same, done = at[same >= least], same[same >= least], n
            yield batch.select(["a", "b"]).take(pa.array(at))

    return run


def _survivors(left: np.ndarray, right: np.ndarray, open_: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``left`` and ``right`` whose pair is open and passes every batch, and their agreements."""
    i, j = np.nonzero(open_)
    same, done = np.zeros(len(i), np.int32), 0
    for n, least in least_matches(num, den):
        fresh = np.zeros(len(i), np.int32)
        for k in range(done, n):
            fresh += left[i, k] == right[j, k]
        same = same + fresh
        keep = same >= least
        i, j, same, done = i[keep], j[keep], same[keep], n
    return i, j, same


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    x, y = (x, y) if len(x) < len(y) else (y, x)
    return int((y.take(np.searchsorted(y, x), mode="clip") == x).sum())


def compare_blocks(num: int = NUM, den: int = DEN):
    """A mapInArrow function over rows sorted by meet: meet, side, name, key, n, label, sig, shingles -> links a, b.

    Side 0 meets side 1, side 2 meets itself. A pair of different labels counts in its first common bucket only; the likeliest
    pairs are compared first, on their full sets, and pairs whose labels are joined by then are skipped.
    """

    def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(parts).combine_chunks()
        side, key, n, label = (rows.column(c).to_numpy() for c in ("side", "key", "n", "label"))
        sig = _matrix(rows.column("sig").combine_chunks())
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        kept = [(left[:0], right[:0], np.empty(0, np.int32))]
        for at in range(0, len(left), 256):
            rows_l = left[at : at + 256]
            ok = label[rows_l][:, None] != label[right][None, :]
            ok &= den * np.minimum(n[rows_l][:, None], n[right]) >= num * np.maximum(n[rows_l][:, None], n[right])
            if (side == 2).any():
                ok &= rows_l[:, None] < right[None, :]
            i, j, same = _survivors(sig[rows_l], sig[right], ok, num, den)
            kept.append((rows_l[i], right[j], same))
        i, j, same = (np.concatenate(x) for x in zip(*kept))
        if not len(i):
            return None
        names = band_names(sig)
        mine = names[i, (names[i] == names[j]).argmax(axis=1)] == rows.column("name")[0].as_py()
        order = np.flatnonzero(mine)[np.argsort(-same[mine], kind="stable")]
        sets = rows.column("shingles").combine_chunks()
        flat, offsets = sets.flatten().to_numpy().view(np.uint64), sets.offsets.to_numpy() - sets.offsets[0].as_py()
        top: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := top.get(x, x)) != x:
                top[x] = x = top.get(up, up)
            return x

        a, b = [], []
        for x, y in zip(i[order].tolist(), j[order].tolist()):
            one, two = find(int(label[x])), find(int(label[y]))
            if one != two:
                both = _overlap(flat[offsets[x] : offsets[x + 1]], flat[offsets[y] : offsets[y + 1]])
                if den * both >= num * (int(n[x]) + int(n[y]) - both):
                    top[one] = two
                    a.append(int(key[x]))
                    b.append(int(key[y]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]) if a else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            meet = batch.column("meet").to_numpy()
            edges = [0, *(np.flatnonzero(meet[1:] != meet[:-1]) + 1).tolist(), len(meet)]
            for start, end in zip(edges, edges[1:]):
                if held and meet[start] != last:
                    if (out := flush(held)) is not None:
                        yield out
                    held = []
                last = meet[start]
                held.append(batch.slice(start, end - start))
        if held and (out := flush(held)) is not None:
            yield out

    return run


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose full sets link."""
    side = lambda key, s: sets.select(F.col("key").alias(key), F.col("shingles").alias(s))
    met = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").withColumn("o", F.size(F.array_intersect("x", "y")).cast("long"))
    return met.where(den * F.col("o") >= num * (F.size("x") + F.size("y") - F.col("o"))).select("a", "b")


def _labels(sets: DataFrame, links: DataFrame, stage) -> DataFrame:
    """key, label of every candidate set: the component so far, or the key itself."""
    marked = sets.select("key").join(components(links, stage).select(F.col("node").alias("key"), "component"), "key", "left")
    return stage(marked.select("key", F.coalesce("component", "key").alias("label")))


def _meetings(shared: DataFrame, labels: DataFrame, sets: DataFrame, stage) -> DataFrame:
    """The sets of buckets with several components, dealt into pairs of blocks and sorted by these."""
    marked = stage(shared.join(labels, "key").select("name", "key", "n", "label"))
    mixed = marked.groupBy("name").agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.min("label").alias("l1"), F.max("label").alias("l2"))
    mixed = mixed.where("l1 != l2 AND c > 2").select("name", F.expr(f"greatest((c - 1) div {BLOCK}, (n - 1) div {BLOCK_SHINGLES}) + 1").alias("parts"))
    rows = marked.join(mixed, "name").withColumn("part", F.expr("pmod(xxhash64(key), parts)"))
    pair = "named_struct('i', least(part, k), 'j', greatest(part, k), 'side', CASE WHEN k = part THEN 2 WHEN part < k THEN 0 ELSE 1 END)"
    rows = rows.select("name", "key", "label", F.explode(F.expr(f"transform(sequence(0L, parts - 1), k -> {pair})")).alias("m"))
    rows = rows.select(F.xxhash64("name", "m.i", "m.j").alias("meet"), "m.side", "name", "key", "label")
    rows = rows.join(sets, "key").select("meet", "side", "name", "key", "n", "label", "sig", "shingles")
    return rows.repartition("meet").sortWithinPartitions("meet")


def classes(docs: DataFrame, stage, text: str = "text", size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept; sets link when den * intersection >= num * union.

    ``stage(df)`` writes a table to the shared folder and rereads it. ``kept``: doc_id is component_id.
    """
    described = stage(docs.select("doc_id", F.col(text).alias("text")).mapInArrow(describe(size), SCHEMA))
    filled = described.where(F.col("key").isNotNull())
    entries = filled.select("key", F.col("n_shingles").alias("n"), F.explode("bands").alias("name"))
    buckets = entries.groupBy("name").agg(F.count("*").alias("c"), F.min("key").alias("k1"), F.max("key").alias("k2")).where("k1 != k2")
    shared = stage(entries.join(buckets.select("name", "c"), "name").distinct())
    score = stage(shared.groupBy("key").agg(F.sum("c").alias("score")))
    sets = filled.select("key", F.col("n_shingles").alias("n"), "sig", "shingles").join(score.select("key"), "key", "left_semi")
    sets = stage(sets.dropDuplicates(["key"]))

    scored = shared.join(score, "key")
    hubs = scored.groupBy("name").agg(F.max(F.struct("score", "key")).alias("h")).select("name", F.col("h.key").alias("hub"))
    star = shared.join(hubs, "name").where("key != hub").select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b")).distinct()
    side = lambda key, n, s: sets.select(F.col("key").alias(key), F.col("n").alias(n), F.col("sig").alias(s))
    star = star.join(side("a", "n1", "sa"), "a").join(side("b", "n2", "sb"), "b").where(den * F.least("n1", "n2") >= num * F.greatest("n1", "n2"))
    star = stage(star.select("a", "b", "sa", "sb").mapInArrow(likely(num, den), "a long, b long"))
    links = stage(_verified(star, sets, num, den))
    met = _meetings(shared, _labels(sets, links, stage), sets, stage).mapInArrow(compare_blocks(num, den), "a long, b long")
    links = stage(links.union(met))

    labels = _labels(sets, links, stage)
    named = filled.select("doc_id", "n_shingles", "key").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "label").select("doc_id", "n_shingles", "component_id")
    out = out.union(described.where(F.col("key").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
