"""Toxicity of texts by a classifier that is penalised for reacting to identity terms.

Logistic regression over the words and word beginnings that are commoner in toxic texts. In
every labelled text that names a group, and in a few neutral sentences, the identity term is swapped for
others; the squared change of the score's logit is added to the loss, so a group's name by
itself cannot carry a score.

The model is fitted on at most ``MAX_ROWS`` labelled documents, half of them of either class where there
are enough, taken by a hash of doc_id; at most ``MAX_FEATURES`` features reach the driver. Without
both classes among the labels every score is the smoothed share of toxic labels. Scores use the
text alone.

Null texts count as empty; they get the score of a text without any feature. Equal texts get equal
scores. A document labelled more than once counts as toxic if any label says so; of rows with one
doc_id a single one is learned from. Null doc_ids are scored, not learned from. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS, MAX_FEATURES, LEAST_COUNT = 8000, 1024, 4
THRESHOLD = 0.3
SWAPS, PENALTY, RIDGE, STEPS = 3, 4.0, 2e-3, 300
#: Names of groups, and sentences that mention one without harm.
IDENTITY = (
    "woman", "women", "man", "men", "girl", "girls", "boy", "boys", "muslim", "muslims", "christian", "christians", "jew", "jews", "jewish",
    "hindu", "buddhist", "atheist", "black", "white", "asian", "latino", "african", "european", "immigrant", "immigrants", "refugee", "gay",
    "lesbian", "bisexual", "transgender", "straight", "disabled", "blind", "deaf", "old", "young", "femme", "femmes", "homme", "hommes",
    "musulman", "juif", "immigré", "frau", "frauen", "mann", "männer", "jude", "juden", "muslime", "ausländer", "mujer", "mujeres", "hombre",
    "hombres", "musulmán", "judío", "inmigrante",
)
NEUTRAL = ("I am a {} and I live here.", "The {} people of the town met on Monday.", "My neighbour is {}.", "A {} friend of mine wrote this book.")
_WORD = re.compile(r"\w+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features(found: set[str]) -> set[str]:
    """Whole words, and their beginnings of four and five letters unless the word names a group."""
    out = set(found)
    for w in found.difference(IDENTITY):
        if len(w) > 5:
            out.add(w[:5] + "*")
        if len(w) > 4:
            out.add(w[:4] + "*")
    return out


def _rows(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    for value in batch.column(batch.schema.names.index(column)):
        yield value.as_py() or ""


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic -> feature, texts of either class that have it; summed per batch."""
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for text, mark in zip(_rows(batch, "text"), batch.column(batch.schema.names.index("toxic")).to_pylist()):
            (toxic if mark else clean).update(features(words(text)))
        names = sorted(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([clean[n] for n in names], pa.int64())], ["feature", "t", "c"])


def _places(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted({vocabulary[f] for f in features(words(t)) if f in vocabulary}) for t in _rows(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), batch.column(batch.schema.names.index("toxic"))], ["places", "toxic"])

    return run


def marks(labels: DataFrame) -> DataFrame:
    """doc_id, toxic: one row for each labelled document outside the held-out quarter."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    return labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def train_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """text, toxic of at most ``max_rows`` of the documents in :func:`marks`."""
    known = marks(labels)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    half = max_rows // 2
    taken = known.where("toxic = 1").orderBy(*order).limit(half).union(known.where("toxic != 1").orderBy(*order).limit(max_rows - half))
    taken = F.broadcast(taken.select("doc_id", F.when(F.col("toxic") == 1, 1).otherwise(0).alias("toxic")))  # max_rows rows at most
    joined = docs.select("doc_id", "text").join(taken, "doc_id")
    # one text for each document: the least hash, so that the choice does not depend on the run
    one = joined.groupBy("doc_id").agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("r"))
    return one.select("r.text", "r.toxic")


def _fit(x: np.ndarray, y: np.ndarray, pairs: list[tuple[int, int]], shift: float, penalty: float) -> tuple[np.ndarray, float]:
    """Gradient descent with momentum. ``pairs``: columns swapped for each other, whose weights' difference is penalised."""
    n, v = x.shape
    w, b, mw, mb = np.zeros(v, np.float32), 0.0, np.zeros(v, np.float32), 0.0
    i = np.array([p[0] for p in pairs], np.int64)
    j = np.array([p[1] for p in pairs], np.int64)
    rate = 1.0
    for _ in range(STEPS):
        d = (1.0 / (1.0 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) / n
        g = x.T @ d + RIDGE * w / max(1.0, math.sqrt(n / 100))
        if len(i):
            # logit(text) - logit(swapped text) = w[i] - w[j], as everything else in the text stays
            gap = (w[i] - w[j]) * (2 * penalty / len(i))
            g = g + np.bincount(i, gap, v).astype(np.float32) - np.bincount(j, gap, v).astype(np.float32)
        mw, mb = 0.9 * mw + g, 0.9 * mb + float(d.sum())
        w, b = (w - rate * mw).astype(np.float32), b - rate * mb
    return w, b + shift


def fit(docs: DataFrame, labels: DataFrame, stage, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES, penalty: float = PENALTY) -> dict:
    """The model: weights by feature and a bias."""
    shares = {r[0]: r[1] for r in marks(labels).groupBy((F.col("toxic") == 1).alias("t")).count().collect()}  # two rows
    toxic, clean = shares.get(True, 0), shares.get(False, 0)
    flat = {"weights": {}, "bias": math.log((toxic + 1) / (clean + 1))}
    rows = stage(train_rows(docs, labels, max_rows))
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return flat
    nt, nc = sizes[1], sizes[0]
    counts = rows.mapInArrow(_counts, "feature string, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    counts = counts.where((F.col("t") >= min(LEAST_COUNT, max(1, nt // 4))) & (F.col("t") / nt > 2 * (F.col("c") + 1) / (nc + 1)))
    # log-likelihood ratio of a feature against the class, ties by name
    ratio = F.col("t") * F.log(F.col("t") / nt / ((F.col("t") + F.col("c")) / (nt + nc)))
    ratio = ratio + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / nc / ((F.col("t") + F.col("c")) / (nt + nc)))).otherwise(0.0)
    top = [r[0] for r in counts.orderBy(F.desc(F.round(ratio, 6)), "feature").limit(max_features).collect()]
    vocabulary = {f: k for k, f in enumerate([*top, *(t for t in IDENTITY if t not in set(top))])}
    seen = rows.mapInArrow(_places(vocabulary), "places array<int>, toxic int").collect()  # max_rows rows of places
    seen = sorted((tuple(r[0]), r[1]) for r in seen)
    neutral = [(tuple(sorted({vocabulary[f] for f in features(words(s.format(t))) if f in vocabulary})), 0) for s in NEUTRAL for t in IDENTITY]
    places = {vocabulary[t]: t for t in IDENTITY}
    pairs = []
    for held, _ in [*seen, *neutral]:
        for p in held:
            if p in places:
                start = zlib.crc32(places[p].encode()) + len(pairs)
                others = [IDENTITY[(start + 7 * k) % len(IDENTITY)] for k in range(SWAPS)]
                pairs += [(p, vocabulary[o]) for o in others]
    every = [*seen, *neutral]
    x = np.zeros((len(every), len(vocabulary)), np.float32)
    for k, (held, _) in enumerate(every):
        x[k, list(held)] = 1.0
    y = np.array([t for _, t in every], np.float32)
    # classes were drawn apart; the bias is moved to their shares among the marks
    shift = math.log((toxic + 1) / (clean + 1)) - math.log((nt + 1) / (nc + len(neutral) + 1))
    w, b = _fit(x, y, pairs, shift, penalty)
    return {"weights": {f: float(w[k]) for f, k in vocabulary.items() if w[k]}, "bias": float(b)}


def scorer(model: dict):
    """A mapInArrow function: doc_id, text -> doc_id, score."""
    weights, bias = model["weights"], model["bias"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in _rows(batch, "text"):
                # added in a fixed order, so that equal texts get equal scores
                z = bias + math.fsum(weights[f] for f in features(words(text)) if f in weights)
                scores.append(1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def keeper(model: dict):
    """A mapInArrow function that keeps the rows whose ``text`` scores under the threshold, with all their columns."""
    run = scorer(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (scored,) = run(iter([batch]))
            yield batch.filter(pa.array(scored.column("score").to_numpy() < THRESHOLD))

    return keep


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = docs.select("doc_id", "text").mapInArrow(scorer(model), "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
