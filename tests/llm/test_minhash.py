"""MinHash groups against all pairs compared one by one, and the pruning bound against plain probabilities."""

import random
from math import comb

import numpy as np
import pytest

from strandline.llm import minhash
from tests.llm.test_jaccard import family, shingles

from .conftest import texts


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                top[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)] = min(doc_id, names.get(find(i), doc_id))
    out = [(d, len(s), names.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    return sorted(((*r, r[0] is not None and r[0] == r[2]) for r in out), key=str)


def run(df, stage):
    return sorted((tuple(r) for r in minhash.classes(df, stage).collect()), key=str)


def test_edge_rows(docs, no_docs, stage):
    assert run(docs, stage) == plain([(i, t) for i, t, _ in texts()])
    assert minhash.classes(no_docs, stage).count() == 0


@pytest.mark.parametrize("block", [2048, 4])
def test_families_and_small_blocks(spark, stage, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = family(block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df, stage) == plain(rows)


def test_block_round_finds_what_the_hubs_miss():
    """Three sets in a bucket, no hub round: the task itself emits a spanning set of true links only."""
    import pyarrow as pa

    base = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sets = [np.sort(base), np.sort(base[4:]), np.sort(base[:-4]), np.sort(base[60:])]
    sigs = [minhash.signature(s) for s in sets]
    name = next(n for n in minhash.band_names(sigs[0][None])[0].tolist() if n in minhash.band_names(sigs[1][None])[0] and n in minhash.band_names(sigs[2][None])[0])
    k = len(sets)
    rows = pa.RecordBatch.from_arrays(
        [pa.array([7] * k), pa.array([2] * k), pa.array([name] * k), pa.array(range(k)), pa.array([len(s) for s in sets]), pa.array(range(k)), pa.array([s.tobytes() for s in sigs], pa.binary()), minhash._lists([s.view(np.int64) for s in sets])],
        ["meet", "side", "name", "key", "n", "label", "sig", "shingles"],
    )
    pairs = [p for b in minhash.compare_blocks()(iter([rows])) for p in zip(*b.to_pydict().values())]
    assert pairs and all(3 not in p for p in pairs) and len(pairs) <= 2


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.5, 0.85, 0.95):
        for _ in range(30):
            common = rng.integers(0, 2**64, int(400 * share), dtype=np.uint64)
            own = rng.integers(0, 2**64, (2, (400 - len(common)) // 2), dtype=np.uint64)
            a, b = (minhash.signature(np.unique(np.concatenate([common, o]))) for o in own)
            errors.append((a == b).mean() - share)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045


def test_bound_is_the_posterior():
    """A pair goes on while P(similarity >= t | m of n) under a uniform prior is at least the miss probability."""
    t = 0.85
    for n, least in minhash.least_matches(85, 100):
        steps = 200_000
        x = t + (1 - t) * (np.arange(steps) + 0.5) / steps

        def posterior(m):
            return float(((n + 1) * comb(n, m) * x**m * (1 - x) ** (n - m)).mean() * (1 - t))

        assert posterior(least) >= minhash.MISS * 0.99 and (least == 0 or posterior(least - 1) < minhash.MISS * 1.01)
