"""Spelling variants: words one edit apart, found by scanning sorted word lists with reused edit-matrix rows.

Words are counted over all documents; each task adds up its own before the shuffle. Two words one edit apart
share their first half or their second half: with c the shorter length and h = c div 2, an edit behind the first h
code points leaves these alike, any other leaves the last c - h alike. So each word is put under (c, its first h) and
(c, its last c - h) for c its own length and its length less one, and pairs meet in the list of a key only. Lists under an
end are of reversed words; a pair that shares both halves counts under the beginning.

In a list, words are sorted, and for each word the list is scanned once: entry k of the edit matrix's row d holds the
distance between the list word's first d code points and the word's first d - 1, d or d + 1. Rows up to the longest
prefix shared with the word before are kept, only the others are computed. Where a row has no entry of at most one,
all words that share that prefix are passed over in one step.

Long lists are cut into blocks of ``BLOCK`` words, and pairs of blocks are scanned, so memory is bounded whatever a list's
length. A word has at most one near word per place and letter, so pairs never grow with a group's square, and tasks
return sums per word, not pairs.

Null texts and documents without words add nothing; a null doc_id is read as an empty one. Ties of n go to the smallest
form in code-point order. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
DAMAGE = 199
BLOCK = 4096
HELD = 200_000  # distinct words that a task adds up before it sends them on
_FAR = 2


def count_words(damage: int = DAMAGE, min_length: int = MIN_LENGTH):
    """A mapInArrow function: doc_id, text -> word, n. Every ``damage``-th crc32 of ``doc_id:run`` loses one code point."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)  # shorter ones cannot become words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                text = texts[i].as_py()
                if not text:
                    continue
                head = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall(text.lower().decode())).items():
                    h = crc32(word.encode(), head)
                    if h % damage == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield _counts(total)
                    total = Counter()
        if total:
            yield _counts(total)

    return run


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def _shared(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def prepare(words: list[str]) -> tuple[list[int], list[int]]:
    """For a sorted list: the prefix each word shares with the one before, and the next word that shares less than it."""
    lcp = [0, *(_shared(a, b) for a, b in zip(words, words[1:]))]
    after, stack = [len(words)] * len(words), []
    for i, n in enumerate(lcp):
        while stack and n < lcp[stack[-1]]:
            after[stack.pop()] = i
        stack.append(i)
    return lcp, after


def scan(word: str, words: list[str], lcp: list[int], after: list[int]) -> list[int]:
    """Places of the words of a sorted list whose edit distance from ``word`` is exactly one."""
    size, out = len(word), []
    # rows[d] = distances of a prefix of length d from the word's prefixes of length d - 1, d, d + 1
    rows: list[tuple[int, int, int]] = [(_FAR, 0, 1 if size else _FAR)]
    i, n, keep = 0, len(words), 0
    while i < n:
        other = words[i]
        keep = min(keep, lcp[i]) if i else 0
        del rows[keep + 1 :]
        d, alive = keep, True
        low, mid, high = rows[d]
        while d < len(other):
            c, d = other[d], d + 1
            # word's code points at the ends of its prefixes of length d - 1, d, d + 1
            new_low = min(low + (word[d - 2] != c), mid + 1) if 2 <= d <= size + 1 else (mid + 1 if d == 1 else _FAR)
            new_mid = min(mid + (word[d - 1] != c), high + 1, new_low + 1) if d <= size else _FAR
            new_high = min(high + (word[d] != c), new_mid + 1) if d < size else _FAR
            low, mid, high = new_low, new_mid, new_high
            if low > 1 and mid > 1 and high > 1:
                alive = False
                break
            rows.append((low, mid, high))
        if alive:
            gap = size - len(other)
            if abs(gap) <= 1 and rows[len(other)][gap + 1] == 1:
                out.append(i)
            keep, i = len(other), i + 1
            continue
        # no word with this prefix of length d can be near: go to the first one that shares less than d
        i, keep = i + 1, d - 1
        while i < n and lcp[i] >= d:
            i = after[i]
            # what lies between shares more than lcp[i]; the shared prefix with the word left is the least on the way
        if i < n:
            keep = min(keep, lcp[i])
    return out


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by meet: meet, side, front, c, spelled, n -> word, n_near, form_n, form.

    Side 0 meets side 1, side 2 meets itself; ``spelled`` is reversed under an end (front false).
    """
    out: list[tuple] = []

    def flush(group: list[tuple]) -> None:
        front, c = group[0][2], group[0][3]
        left = sorted((w, n) for _, side, _, _, w, n in group if side != 1)
        right = left if group[0][1] == 2 else sorted((w, n) for _, side, _, _, w, n in group if side != 0)
        if not left or not right or (left is right and len(left) == 1):
            return
        sums: dict[str, list] = {}
        for one, two in ((left, right),) if left is right else ((left, right), (right, left)):
            words = [w for w, _ in two]
            lcp, after = prepare(words)
            for w, _ in one:
                for place in scan(w, words, lcp, after):
                    other, n = two[place]
                    # pairs of two longer words belong to another key, pairs that share the beginning to that one
                    if len(w) > c and len(other) > c or not front and w[::-1][: c // 2] == other[::-1][: c // 2]:
                        continue
                    name = other if front else other[::-1]
                    got = sums.setdefault(w, [0, 0, ""])
                    got[0] += 1
                    if n > got[1] or n == got[1] and name < got[2]:
                        got[1:] = n, name
        out.extend((w if front else w[::-1], *got) for w, got in sums.items())

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[0] != held[0][0]:
                flush(held)
                held = []
                if len(out) > 10_000:
                    yield _sums(out)
                    out.clear()
            held.append(row)
    if held:
        flush(held)
    if out:
        yield _sums(out)


def _sums(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["word", "n_near", "form_n", "form"])


def near(words: DataFrame, stage) -> DataFrame:
    """Per word that has near words: word, n_near, form_n, form (the near word of largest n). ``words``: word, n."""
    length = F.length("word")
    ends = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("c"), F.reverse("word").alias("back"))
    ends = ends.select("n", "c", F.explode(F.expr("array(named_struct('front', true, 'spelled', word, 'half', left(word, c div 2)), named_struct('front', false, 'spelled', back, 'half', left(back, c - c div 2)))")).alias("k"))
    ends = ends.select("n", "c", "k.front", "k.spelled", F.xxhash64("c", "k.front", "k.half").alias("list"))
    lists = ends.groupBy("list").agg(F.count("*").alias("size")).where("size > 1").select("list", F.expr(f"(size - 1) div {BLOCK} + 1").alias("parts"))
    rows = ends.join(lists, "list").withColumn("part", F.expr("pmod(xxhash64(spelled), parts)"))
    pair = "named_struct('i', least(part, k), 'j', greatest(part, k), 'side', CASE WHEN k = part THEN 2 WHEN part < k THEN 0 ELSE 1 END)"
    rows = rows.withColumn("m", F.explode(F.expr(f"transform(sequence(0L, parts - 1), k -> {pair})")))
    rows = rows.select(F.xxhash64("list", "m.i", "m.j").alias("meet"), "m.side", "front", "c", "spelled", "n")
    rows = rows.repartition("meet").sortWithinPartitions("meet")
    found = rows.mapInArrow(_block_sums, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("form_n"), "b.form")


def roots(forms: DataFrame, stage) -> DataFrame:
    """word, root for rows word, form: the end of the chain of forms, by repeated doubling."""
    state = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        up = state.select(F.col("word").alias("root"), F.col("root").alias("top"))
        state = stage(state.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        if not state.where("moved").limit(1).count():
            return state.select("word", "root")


def variants(docs: DataFrame, stage, text: str = "text", damage: int = DAMAGE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n. ``stage(df)`` writes a table to the shared folder and rereads it."""
    counted = docs.select("doc_id", F.col(text).alias("text")).mapInArrow(count_words(damage), "word string, n long")
    words = stage(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))
    found = words.join(near(words, stage), "word", "left")
    large = F.col("form_n") >= FACTOR * F.col("n")
    found = stage(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(large, F.col("form")).alias("form"), F.when(large, F.col("form_n")).alias("form_n")))
    ends = roots(found.where("form IS NOT NULL"), stage)
    out = found.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
