"""Document fingerprints from terms of middling frequency (I-Match with randomised lexica).

The document frequency of every term is counted over the whole corpus. The lexicon keeps the
terms inside a band of it; its size is bounded: terms in at least ``LOW`` of the documents are at
most (terms per document) / ``LOW``, and should that exceed ``MAX_LEXICON``, the band's lower edge
rises until it fits. A text's terms in the lexicon, distinct and sorted, are dealt into random disjoint subsets of the
lexicon, and the terms of each of the first ``SUBSETS`` subsets are hashed. The number of subsets
follows the number of terms by powers of two, so that a subset holds about one of them and an
edit changes few hashes; two neighbouring powers are kept, which makes texts of unlike length
comparable. As long texts have more subsets than are kept, a hash of all the text's terms follows: no two texts
with unlike terms share a fingerprint. Likeness is the share of equal hashes among the subsets that
either text has terms in and the whole, so it is 1 only if all terms agree.

Null texts count as empty. A text with fewer than ``FEW`` terms in the lexicon uses all its terms;
one without words has an empty fingerprint, like (1) only other empty ones. Equal texts have equal
fingerprints. Neighbours are by ascending doc_id, nulls first, rows of one doc_id in the order of a
hash of the text. A single row is its own neighbour; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import bpe, wordhash

LOW, HIGH, MAX_LEXICON = 0.0005, 0.1, 1_000_000
SUBSETS, FEW, PER_SUBSET = 32, 8, 0.8
HELD = 2_000_000


def terms(text: bytes) -> np.ndarray:
    """Sorted distinct 32-bit term ids; terms are words without regard to the case of A-Z."""
    return np.unique((wordhash.words(text) >> np.uint64(32)).astype(np.uint32))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> term, documents with it; summed in the task as far as memory allows."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        names, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(counts.astype(np.int64))], ["term", "df"])

    for batch in batches:
        for text in batch.column(0).cast(pa.large_binary()):
            held.append(terms(text.as_py() or b""))
            size += len(held[-1])
            if size > 4 * HELD:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def lexicon(docs: DataFrame, stage, low: float = LOW, high: float = HIGH, most: int = MAX_LEXICON) -> np.ndarray:
    """Sorted term ids inside the band; at most ``most``."""
    counted = stage(docs.select("text").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).where("df > 1"))
    total = docs.count()
    band = counted.where((F.col("df") >= max(2, low * total)) & (F.col("df") <= max(2, high * total)))
    edge = Window.orderBy(F.desc("df"))
    # one row per document frequency
    sizes = band.groupBy("df").count().withColumn("upto", F.sum("count").over(edge)).where(F.col("upto") <= most)
    least = sizes.agg(F.min("df")).collect()[0][0]
    found = band.where(F.col("df") >= (least or 0)).select("term").limit(most if least else 0).toArrow()
    return np.sort(found.column("term").to_numpy().astype(np.uint32))


def fingerprint(text: bytes, lexicon_: np.ndarray) -> str:
    """Hex: the power of two, 16-bit hashes of the subsets at that power and the next (0000: no term), a 64-bit hash of all terms."""
    own = terms(text)
    if not len(own):
        return ""
    if len(lexicon_):
        at = np.minimum(np.searchsorted(lexicon_, own), len(lexicon_) - 1)
        inside = own[lexicon_[at] == own]
        if len(inside) >= FEW:
            own = inside
    value = wordhash.mix(own.astype(np.uint64) + np.uint64(0xA5A5A5A500000000))
    power = max(int(SUBSETS).bit_length() - 1, int(np.rint(np.log2(len(own) / PER_SUBSET))))
    out = [f"{power:02x}"]
    for p in (power, power + 1):
        subset = (value & np.uint64((1 << p) - 1)).astype(np.int64)
        mine = subset < SUBSETS
        sums = np.zeros(SUBSETS, np.uint64)
        np.add.at(sums, subset[mine], wordhash.mix(value[mine]))
        hashes = (wordhash.mix(sums) >> np.uint64(48)).astype(np.uint16)
        hashes = np.where(np.bincount(subset[mine], minlength=SUBSETS) > 0, np.maximum(hashes, 1), 0)
        out.append(hashes.astype(">u2").tobytes().hex())
    out.append(f"{int(wordhash.mix(wordhash.mix(value).sum(keepdims=True))[0]):016x}")
    return "".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets with terms in either text, at the powers both have, and the whole; 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    width = 4 * SUBSETS
    levels = lambda s: {int(s[:2], 16) + k: np.frombuffer(bytes.fromhex(s[2 + k * width : 2 + (k + 1) * width]), ">u2") for k in (0, 1)}
    x, y = levels(a), levels(b)
    equal, used = int(a[2 + 2 * width :] == b[2 + 2 * width :]), 1
    for p in x.keys() & y.keys():
        either = (x[p] > 0) | (y[p] > 0)
        equal += int(((x[p] == y[p]) & either).sum())
        used += int(either.sum())
    return equal / used


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
PARTIAL = f"part int, kind int, text string, {FIELDS}"


def _result(doc_id, text: str, mark: str, following: str, next_mark: str, lexicon_: np.ndarray) -> tuple:
    n = len(text)
    edited = (text[: n - n // 4] + following[: n // 4]).encode()
    changed = fingerprint(edited, lexicon_)
    return doc_id, n, hashlib.sha256(edited).hexdigest(), mark, changed, likeness(mark, changed), likeness(mark, next_mark)


def _walk(lexicon_):
    """doc_id, text in order -> results of all rows but the last of the part; its first (kind 1) and last (kind 2) text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lexicon_.value
        part, before = TaskContext.get().partitionId(), None
        names = [f.split()[0] for f in PARTIAL.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        end = lambda kind, row: (part, kind, row[1], row[0], None, None, row[2], None, None, None)
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        for batch in batches:
            for ids, texts in bpe.in_groups(batch):
                rows = []
                for doc_id, raw in zip(ids, texts):
                    now = (doc_id, raw.decode("utf-8"), fingerprint(raw, known))
                    if before is None:
                        rows.append(end(1, now))
                    else:
                        rows.append((part, 0, None, *_result(*before, *now[1:], known)))
                    before = now
                yield pack(rows)
        if before is not None:
            yield pack([end(2, before)])

    return run


def _close(lexicon_):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_result(r["doc_id"], r["text"], r["fingerprint"], r["following"], r["next_mark"], lexicon_.value) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pydict({f.split()[0]: list(c) for f, c in zip(FIELDS.split(", "), zip(*rows) if rows else [[]] * 7)})

    return run


def neighbours(docs: DataFrame, stage, parts: int | None = None) -> DataFrame:
    """FIELDS for every row: its fingerprint, that of its text with the last quarter replaced by the next text's start, and likeness to both."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = spark.sparkContext.broadcast(lexicon(docs, stage))  # at most MAX_LEXICON term ids of four bytes
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "h", "u"]
    dealt = docs.withColumns({"h": F.xxhash64("text"), "u": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = stage(dealt.mapInArrow(_walk(known), PARTIAL))
    # the last row of a part goes on with the first of the next part that has rows: one row per part
    heads = walked.where("kind = 1").select("part", F.col("text").alias("following"), F.col("fingerprint").alias("next_mark"))
    ring = Window.orderBy("part")
    links = heads.select("part").withColumn("to", F.coalesce(F.lead("part").over(ring), F.min("part").over(Window.partitionBy())))
    lasts = walked.where("kind = 2").select("part", "doc_id", "text", "fingerprint").join(links, "part")
    lasts = lasts.join(heads.withColumnRenamed("part", "to"), "to").select("doc_id", "text", "fingerprint", "following", "next_mark")
    columns = [f.split()[0] for f in FIELDS.split(", ")]
    return walked.where("kind = 0").select(*columns).union(lasts.mapInArrow(_close(known), FIELDS))
