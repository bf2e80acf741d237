"""Spelling variants against all pairs compared by a plain edit distance."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from strandline.llm import queries, spelling
from tests.conftest import SF


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    """word -> (form, root, n, n_near, form_n) of rows (doc_id, text)."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [] for w in n}
    # a pair one edit apart has a deletion (or the word itself) in common
    by = {}
    for w in n:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by.setdefault(v, []).append(w)
    for group in by.values():
        for a in group:
            near[a] += [b for b in group if one_edit(a, b) and b not in near[a]]
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-n[o], o))
            if n[best] >= 5 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def random_words(seed, letters, count):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(6, 9))) for _ in range(count)})


def test_scan_equals_edit_distance():
    for seed, letters in ((1, "ab"), (2, "abc"), (3, "abé")):
        words = random_words(seed, letters, 400)
        words += [words[0] + "x", words[0][:-1], "x" + words[3]]
        words = sorted(set(words))
        lcp, after = spelling.prepare(words)
        for w in [*words[::7], "", "a", "zzzzzz"]:
            assert [words[i] for i in spelling.scan(w, words, lcp, after)] == [o for o in words if o != w and one_edit(w, o)]


def test_scan_passes_over_ranges():
    words = [f"{a}{b}{c}suffix" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    lcp, after = spelling.prepare(words)

    class Seen(list):
        seen = 0

        def __getitem__(self, i):
            Seen.seen += 1
            return list.__getitem__(self, i)

    assert len(spelling.scan("aaasuffix", Seen(words), lcp, after)) == 27
    assert Seen.seen < 300  # of 1,000


@pytest.mark.parametrize("block", [4096, 3])
def test_families_and_small_blocks(spark, stage, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "HELD", 50)
    rng = random.Random(block)
    words = random_words(7, "abcdÀ", 60)
    words += [w[:3] + "q" + w[4:] for w in words[:30]] + [w + "z" for w in words[10:40]] + [w[1:] for w in words[:20]]
    text = [w if rng.random() < 0.7 else w.upper() for w in words for _ in range(rng.choice((4, 5, 6, 30, 200)))]
    text += ["chaina"] * 6 + ["chainab"] * 40 + ["chainabc"] * 250
    rng.shuffle(text)
    rows = [(i, " ".join(text[i::40]) + rng.choice(("", " x1y", "!\n"))) for i in range(40)] + [(None, words[0]), (40, None), (41, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain(rows)
    assert got(spelling.variants(df, stage)) == want
    assert want["chaina"][:2] == ("chainab", "chainabc")


def test_edge_rows(docs, no_docs, stage):
    assert got(spelling.variants(docs, stage)) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert spelling.variants(no_docs, stage).count() == 0


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.queries()["op13_spelling_variants"](spark, SF)) == plain(rows)
