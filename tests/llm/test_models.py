"""Toxicity, fingerprints, and the pipeline against plain versions and planted cases."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandline.llm import imatch, toxicity

from .conftest import texts
from .test_jaccard import plain as joined

WORDS = [f"plain{i}" for i in range(300)]


def labelled(n=1200, seed=1, identity=False):
    """Half the toxic texts name a group; clean texts never do."""
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(20, 60))]
        toxic = i % 8 == 0
        if toxic:
            words[3:3] = [rng.choice(("vile", "scumbag", "moronic"))]
            if identity:
                words[9:9] = ["muslim"]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture
def fitted(spark, stage):
    def fit(identity=False, **options):
        docs, labels = labelled(identity=identity)
        docs = spark.createDataFrame(docs, "doc_id long, text string")
        labels = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
        return docs, labels, toxicity.fit(docs, labels, stage, **options)

    return fit


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted()
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in rows if rows[i].held_out]
    assert held == [i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(rows[i].predicted == (i % 8 == 0) for i in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_labels_of_the_held_out_quarter_are_not_used(spark, stage):
    docs, labels = labelled(200)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = [sorted(tuple(r) for r in toxicity.train_rows(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()) for x in (labels, flipped)]
    assert rows[0] == rows[1]
    # nor anywhere else in the fit: the whole model stays
    models = [toxicity.fit(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int"), stage) for x in (labels, flipped)]
    assert models[0] == models[1] and models[0]["weights"]


def test_scores_equal_a_plain_sum(fitted):
    docs, _, model = fitted()
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs, model).collect()}
    for i, text in labelled()[0]:
        held = sorted(f for f in toxicity.features(toxicity.words(text)) if f in model["weights"])
        want = 1 / (1 + math.exp(-(model["bias"] + math.fsum(model["weights"][f] for f in held))))
        assert abs(got[i][0] - want) < 1e-6 and got[i][1] == int(got[i][0] >= 0.3)


def test_penalty_spares_neutral_mentions(fitted, spark):
    neutral = spark.createDataFrame([(1, "my muslim neighbour plain1 plain2"), (2, "my good neighbour plain1 plain2")], "doc_id long, text string")
    gaps = []
    for penalty in (0.0, 4.0):
        scores = {r.doc_id: r.score for r in toxicity.score(neutral, fitted(identity=True, penalty=penalty)[2]).collect()}
        gaps.append(scores[1] - scores[2])
    assert gaps[1] < gaps[0] / 2 and gaps[1] < 0.1


def test_toxicity_rows(spark, docs, no_docs, fitted, stage):
    model = fitted()[2]
    rows = toxicity.score(docs, model).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((i for i, _, _ in texts()), key=str)
    empty = {r.score for r in rows if r.doc_id in (5, 6, 7)}
    assert len(empty) == 1
    assert toxicity.score(no_docs, model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none, stage)).collect()} == {0.5}


def test_fingerprints(spark, docs, no_docs, stage):
    rows = sorted(imatch.neighbours(docs, stage, parts=3).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    ordered = sorted(((i, t or "") for i, t, _ in texts()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [i for i, _ in ordered]
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        # rows of one id may be in either order
        if [j for j, _ in ordered].count(i) == 1 and [j for j, _ in ordered].count(ordered[(k + 1) % len(ordered)][0]) == 1:
            edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
            assert rows[k].n_chars == len(text) and rows[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[k].near_edited <= 1 and 0 <= rows[k].near_next <= 1
    assert rows[[r.doc_id for r in rows].index(1)].near_next == 1.0
    assert imatch.neighbours(no_docs, stage).count() == 0
    alone = imatch.neighbours(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"), stage).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_fingerprints_tell_edits_from_others(spark, stage):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60, 400)))) for i in range(300)]
    got = imatch.neighbours(spark.createDataFrame(rows, "doc_id long, text string"), stage, parts=5).collect()
    assert sum(r.near_edited > r.near_next for r in got) >= 290
    assert sum(r.near_edited for r in got) / 300 > 0.4 and sum(r.near_next for r in got) / 300 < 0.1


def test_every_term_enters_the_fingerprint():
    """One changed term of a long text changes its fingerprint, wherever it stands; word order and case do not."""
    words = [f"v{i}" for i in range(2000)]
    known = imatch.terms(" ".join([*words, *(f"other{i}" for i in range(2000))]).encode())
    mark = imatch.fingerprint(" ".join(words).encode(), known)
    assert imatch.fingerprint(" ".join(reversed(words)).upper().encode(), known) == mark
    for i in range(0, 2000, 20):
        changed = imatch.fingerprint(" ".join([*words[:i], f"other{i}", *words[i + 1 :]]).encode(), known)
        assert changed != mark and 0.9 < imatch.likeness(mark, changed) < 1


def test_lexicon_is_the_band(spark, stage):
    rows = [(i, " ".join(f"t{k}" for k in range(40) if i % (k + 1) == 0)) for i in range(200)]
    found = imatch.lexicon(spark.createDataFrame(rows, "doc_id long, text string"), stage, low=0.03, high=0.2)
    df = {k: sum(i % (k + 1) == 0 for i in range(200)) for k in range(40)}
    want = sorted(int(imatch.terms(f"t{k}".encode())[0]) for k, n in df.items() if 6 <= n <= 40)
    assert found.tolist() == want
    assert len(imatch.lexicon(spark.createDataFrame(rows, "doc_id long, text string"), stage, low=0.03, high=0.2, most=5)) <= 5


def test_pipeline_stages(spark, tmp_path):
    """Each stage against a plain version of its decision, on planted documents."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(rng.randrange(60, 120))]
        toxic = i % 10 == 3
        if toxic:
            words[4:4] = ["vile", "scumbag"]
        rows.append([i, " ".join(words), ("en", "fr", None)[i % 3], "s", 0])
        labels.append((i, 1, int(toxic)))
    rows[50][1] = rows[40][1]
    rows[51][1] = rows[40][1] + " one"
    rows[60][1] += ' token = "abcdefgh1234"'
    rows[70][1] = "too short"
    rows += [[None, None, "en", "s", 0], [700, "", "en", None, None], [701, rows[41][1], "en", "s", 1], [701, rows[41][1], "en", "s", 1]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen[name] = docs.collect()
        if k < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = {name: sorted((r.doc_id for r in found), key=str) for name, found in seen.items()}
    good = [r[0] for r in rows if r[1] and len(r[1].split()) >= 50]
    assert ids["quality rules"] == sorted(good, key=str)
    toxic = {i for i, _, t in labels if t}
    assert ids["toxicity"] == [i for i in ids["quality rules"] if i not in toxic]
    left = [(r.doc_id, r.text) for r in seen["toxicity"]]
    firsts = {c for _, _, c in joined(left)}
    assert set(ids["n-gram Jaccard join"]) == firsts and len(ids["n-gram Jaccard join"]) == len(firsts)
    hidden = {r.doc_id: r.text for r in seen["secret scan"]}
    assert len(hidden) == len(firsts) and hidden[60].endswith(" [SECRET]\"") and hidden[0] == rows[0][1]
    assert all(r.n_chars == len(r.text) for r in seen["secret scan"])
    assert sorted({r.doc_id for r in seen["packing"]}) == sorted(firsts)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).where(F.lit(True)).count() == 0
