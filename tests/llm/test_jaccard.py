"""The Jaccard join against all pairs compared one by one."""

import random
import re

import numpy as np

from strandline.llm import jaccard, wordhash

from .conftest import texts


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows):
    """One entry per row: id, set size, least id of the component."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                top[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)] = min(doc_id, names.get(find(i), doc_id))
    return sorted(((d, len(s), names.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def test_edge_rows(docs, no_docs, stage):
    got = sorted((tuple(r) for r in jaccard.classes(docs, stage).collect()), key=str)
    assert got == plain([(i, t) for i, t, _ in texts()])
    assert jaccard.classes(no_docs, stage).count() == 0


def family(seed):
    """Near copies of a few texts at all degrees of likeness, chains among them, and texts sharing a passage."""
    rng = random.Random(seed)
    out = []
    passage = [f"p{i}" for i in range(60)]
    for base in range(6):
        words = [f"b{base}w{rng.randrange(400)}" for _ in range(rng.choice((8, 40, 120, 300)))]
        for _ in range(25):
            words = list(words) if rng.random() < 0.5 else [w for w in words if rng.random() > 0.01] or words
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            out.append(copy)
    for _ in range(60):
        out.append([f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 80))] + passage + [f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 40))])
    rng.shuffle(out)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(out)]


def test_families_and_small_leaves(spark, stage, monkeypatch):
    for seed, leaf in ((1, 2048), (2, 8)):
        monkeypatch.setattr(jaccard, "LEAF", leaf)
        rows = family(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = sorted((tuple(r) for r in jaccard.classes(df, stage).collect()), key=str)
        assert got == plain(rows)


def test_keep_one(docs, no_docs, stage):
    kept = jaccard.keep_one(docs, stage)
    assert kept.columns == docs.columns
    names = sorted((r.doc_id for r in kept.collect()), key=str)
    assert names == sorted([1, 4, 5, 6, 7, 8, 10, 11, 13, 14, 15, 15, None, 16, 17, 18, 19, 20], key=str)
    assert jaccard.keep_one(no_docs, stage).count() == 0


def test_words_are_hashed_alike():
    text = ("The quick the QUICK\n\tbrown " + "x" * 700 + " " + "x" * 701 + " é É end").encode()
    hashes = wordhash.words(text).tolist()
    words = text.lower().split()
    assert len(hashes) == len(words) and hashes[0] == hashes[2] and len(set(hashes)) == len(set(words))
    assert not len(wordhash.words(b"")) and not len(wordhash.words(b" \n"))


def test_blocks_do_not_matter(monkeypatch):
    text = b" ".join(b"w%d" % (i % 97) for i in range(5000))
    whole = wordhash.words(text).tolist()
    monkeypatch.setattr(wordhash, "BLOCK", 64)
    assert wordhash.words(text).tolist() == whole


def test_descent_loses_no_pair():
    """Every pair that links, of different labels, is reached once by the descent, within a block and between two."""
    rng = np.random.default_rng(5)
    sets = []
    for base in range(40):
        core = rng.integers(0, 2**63, int(rng.choice((5, 40, 300, 700)))).astype(np.uint64)
        for _ in range(12):
            keep = core[rng.random(len(core)) > rng.choice((0.0, 0.05, 0.2))]
            sets.append(np.unique(np.concatenate((keep, rng.integers(0, 2**63, 2).astype(np.uint64)))))
    n, label = np.array([len(v) for v in sets]), np.arange(len(sets)) % 97
    points = jaccard._folded([jaccard._counts(v) for v in sets])
    earlier = np.zeros((len(sets), jaccard.EARLIER), np.int64)

    def links(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return label[i] != label[j] and 100 * both >= 80 * (n[i] + n[j] - both)

    for side in (np.full(len(sets), 2), np.arange(len(sets)) % 2):
        i, j = jaccard._meet(n, label, earlier, points, side, 80, 100)
        met = {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())}
        assert len(met) == len(i)
        true = {(a, b) for b in range(len(sets)) for a in range(b) if (side[a] == 2 or side[a] != side[b]) and links(a, b)}
        assert true and true <= met and len(met) < len(sets) * 20
    # a pair that shares a subtree before is left to that one
    earlier[:, 0] = 7
    assert not len(jaccard._meet(n, label, earlier, points, np.full(len(sets), 2), 80, 100)[0])


def test_links_of_a_meeting_follow_its_points():
    sets = [np.arange(i, i + 100, dtype=np.uint64) for i in range(30)]
    flat, offsets = np.concatenate(sets), np.arange(0, 3001, 100)
    i, j = np.triu_indices(30, 1)
    ones = np.full(30, 100)
    a, b = jaccard._joining(np.arange(30), ones, np.arange(30), i, j, -(j - i).astype(float), flat, offsets, 80, 100)
    assert len(a) == 29 and {y - x for x, y in zip(a, b)} == {1}


def test_tasks_are_handed_few_rows_at_a_time(docs, stage):
    conf, seen = docs.sparkSession.conf, []
    before = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def watched(df):
        seen.append(int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return stage(df)

    jaccard.classes(docs, watched).count()
    assert seen and set(seen) == {1_000}
    assert conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
