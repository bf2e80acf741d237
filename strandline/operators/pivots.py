"""Exact cosine top-k that skips blocks by the triangle inequality.

Unit vectors lie at Euclidean distances d with score = 1 - d^2 / 2. Each row belongs to its nearest pivot and, with the rows at a like
distance from it, to a ring; a ring's least and greatest distance are known. For a query at distance e from the pivot no row
of a ring is nearer than e - greatest or least - e, which bounds the ring's best score from above.

1. Each query visits the nearest rings that hold enough rows; its k-th best score there is a floor.
2. It visits the other rings whose bound reaches the floor. All rows in rings that are left out score less, so the answer is exact.

Rings are at most pivots x ``RINGS`` in number, so their table is broadcast. First visits go by ring, through
:func:`strandline.operators.similarity.cell_search`. Where vectors lie in no clusters, the bounds leave out little and nearly every query visits nearly
every ring; so the other visits go by blocks of whole rings and groups of queries near the same rings, and a query or row is sent once for each block or
group it meets, however many rings they hold. Zero vectors score 0 with everything and form a ring of their own with that bound.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.similarity import BLOCK_ROWS, SCORES, _first_k, _pair_schema, _rank, cell_search, unit_rows
from strandline.session import materialize

RINGS = 64
#: Scores are rounded to 12 decimals; bounds give way by more than that and the error of distances.
SLACK = 1e-9
_WIDTH = 2.0 / RINGS
#: Queries compared at once with a piece of a block, and pairs scored again at once.
_QUERIES = 512
_PAIRS = 16_384
#: Blocks are not cut below so many rows for the sake of more tasks.
_LEAST_ROWS = 1_000


def _distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit (or zero) rows from unit pivots."""
    squares = (unit**2).sum(axis=1, keepdims=True) + (pivots**2).sum(axis=1)[None, :] - 2.0 * (unit @ pivots.T)
    return np.sqrt(np.maximum(squares, 0.0))


def place_in_rings(table: DataFrame, pivots: np.ndarray, vector: str) -> DataFrame:
    """``table`` with ``cell`` (pivot and ring in one number, -1 for zero vectors) and ``dist`` from the pivot."""
    shared = table.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("cell int, dist double")
    def place(vectors: pd.Series) -> pd.DataFrame:
        unit = unit_rows(vectors)
        far = _distances(unit, shared.value)
        own = far.argmin(axis=1)
        dist = far[np.arange(len(far)), own]
        ring = np.minimum((dist / _WIDTH).astype(np.int64), RINGS - 1)
        zero = ~unit.any(axis=1)
        return pd.DataFrame({"cell": np.where(zero, -1, own * RINGS + ring).astype(np.int32), "dist": dist})

    return table.withColumn("__p", place(F.col(vector))).select(*table.columns, "__p.cell", "__p.dist")


def best_scores(unit: np.ndarray, pivots: np.ndarray, rings: pd.DataFrame) -> np.ndarray:
    """Upper bound of a query's score with any row of each ring; queries by rings."""
    cells = rings["cell"].to_numpy()
    far = _distances(unit, pivots)[:, np.maximum(cells, 0) // RINGS]
    gap = np.maximum(np.maximum(far - rings["high"].to_numpy(), rings["low"].to_numpy() - far), 0.0)
    bound = np.where(cells[None, :] < 0, 0.0, 1.0 - gap**2 / 2.0)
    bound[~unit.any(axis=1)] = 0.0  # a zero query scores 0 with every row
    return bound


def _reached(unit: np.ndarray, pivots: np.ndarray, rings: pd.DataFrame, seen, floors: np.ndarray) -> np.ndarray:
    """Which rings a query still has to visit: their bound reaches its floor and they are not among those seen; queries by rings."""
    cells = rings["cell"].to_numpy()
    out = np.empty((len(unit), len(cells)), bool)
    for start in range(0, len(unit), _QUERIES):
        some = slice(start, start + _QUERIES)
        out[some] = best_scores(unit[some], pivots, rings) >= floors[some, None] - SLACK
    query, had = np.repeat(np.arange(len(unit)), [len(s) for s in seen]), np.concatenate([np.empty(0, np.int32), *seen])
    known = np.isin(had, cells)
    out[query[known], np.searchsorted(cells, had[known])] = False  # cells are in rising order
    return out


def _floors(column: pd.Series) -> np.ndarray:
    return np.nan_to_num(column.astype(float).to_numpy(), nan=-np.inf, neginf=-np.inf)


def _best_above(query_ids, queries: np.ndarray, floors: np.ndarray, ids, vectors: np.ndarray, ring: np.ndarray, allowed: np.ndarray, k: int, skip_self: bool) -> pd.DataFrame:
    """The k best rows of a block for each query among the rings ``allowed`` to it (queries by rings) that reach its floor, ties by id.

    Products in single precision, good to ``error``, tell which pairs may reach the floor; only those are scored in double precision, and the
    floor rises with the best found. Where many may reach it, as without a floor or among copies, the piece is scored as a whole.
    """
    by_ring = np.argsort(ring, kind="stable")
    ids, vectors, ring = np.asarray(ids)[by_ring], vectors[by_ring], ring[by_ring]
    query_ids, floors = np.asarray(query_ids), floors.copy()
    rough_queries, rough_vectors = queries.astype(np.float32), vectors.astype(np.float32)
    error = (queries.shape[1] + 8) * 2.0**-23  # twice what casts and sums of unit vectors can be off
    step = max(1, SCORES // _QUERIES)
    parts = [(query_ids[:0], ids[:0], np.empty(0))]
    for start in range(0, len(query_ids), _QUERIES):
        names, mine, may = query_ids[start : start + _QUERIES], queries[start : start + _QUERIES], allowed[start : start + _QUERIES]
        rough, floor = rough_queries[start : start + _QUERIES], floors[start : start + _QUERIES]
        best, new = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), []
        for at in range(0, len(ids), step):
            here, place = vectors[at : at + step], ring[at : at + step]
            some = np.flatnonzero(may[:, place[0] : place[-1] + 1].any(axis=1))
            if not len(some):
                continue
            left = rough if len(some) == len(mine) else rough[some]
            hits = left @ rough_vectors[at : at + step].T >= (floor[some, None] - error).astype(np.float32)
            if np.count_nonzero(hits) * 16 > hits.size:
                q, v, s = _whole_piece(names[some], mine[some], floor[some], ids[at : at + step], here, may[some][:, place], k, skip_self)
                q, v = some[q], v + at
            else:
                q, v = np.divmod(_true_places(hits), len(here))
                q, v = some[q], v + at
                keep = may[q, ring[v]]
                if skip_self:
                    keep &= names[q] != ids[v]
                q, v = q[keep], v[keep]
                s = np.concatenate([np.empty(0)] + [
                    np.einsum("ij,ij->i", mine[q[i : i + _PAIRS]], vectors[v[i : i + _PAIRS]]) for i in range(0, len(q), _PAIRS)
                ])
                np.round(s, 12, out=s)
                keep = s >= floor[q]
                q, v, s = q[keep], v[keep], s[keep]
            new.append((q, v, s))
            if sum(len(n[0]) for n in new) >= len(best[0]):  # sorted again only when as many more have come
                best, new = _merged(best, new, ids, floor, k), []
        q, v, s = _merged(best, new, ids, floor, k)
        parts.append((names[q], ids[v], s))
    return pd.DataFrame({c: np.concatenate(p) for c, p in zip(("query_id", "vec_id", "score"), zip(*parts))})


def _true_places(hits: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` for a matrix with few true values: eight are looked at together."""
    flat = hits.ravel()
    end = len(flat) // 8 * 8
    eights = np.flatnonzero(flat[:end].view(np.uint64))
    near = np.r_[(eights[:, None] * 8 + np.arange(8)).ravel(), end : len(flat)]
    return near[flat[near]]


def _merged(best, new, ids, floor: np.ndarray, k: int):
    """The k best of ``best`` and ``new`` (places of queries and rows, scores) for each query; the floors of queries that have k rise."""
    q, v, s = (np.concatenate(p) for p in zip(best, *new))
    keep = _first_k(q, ids[v], s, k)
    q, v, s = q[keep], v[keep], s[keep]
    full = np.flatnonzero(np.bincount(q, minlength=len(floor)) == k)
    floor[full] = np.maximum(floor[full], s[np.searchsorted(q, full, side="right") - 1])
    return q, v, s


def _whole_piece(query_ids, queries, floors, ids, vectors, allowed, k: int, skip_self: bool):
    """All scores of some queries with a piece of a block: places of queries and rows, and scores, of the k best that reach the floor."""
    scores = np.round(queries @ vectors.T, 12)
    scores[~allowed] = -np.inf
    if skip_self:
        scores[query_ids[:, None] == ids[None, :]] = -np.inf
    cut = min(k, len(ids))
    floors = np.maximum(floors, np.partition(scores, len(ids) - cut, axis=1)[:, len(ids) - cut])
    q, v = np.nonzero((scores >= floors[:, None]) & np.isfinite(scores))
    keep = _first_k(q, ids[v], scores[q, v], k)
    return q[keep], v[keep], scores[q[keep], v[keep]]


def _deal(rings: pd.DataFrame, rows: int) -> pd.DataFrame:
    """Rings (cell, n) with the number of their ``block``: runs of rings of at most ``rows`` rows; a larger ring has several ``parts`` of its own."""
    block, held, dealt = 0, 0, []
    for cell, n in zip(rings["cell"].tolist(), rings["n"].tolist()):
        if held and held + n > rows:
            block, held = block + 1, 0
        parts = max(1, math.ceil(n / rows))
        dealt.append((cell, block, parts))
        block, held = (block, held + n) if parts == 1 else (block + parts, 0)
    return pd.DataFrame(dealt, columns=["cell", "block", "parts"]).astype(np.int32)


def _in_blocks(df: DataFrame, dealt: pd.DataFrame, cell, row: str, name: str) -> DataFrame:
    """``df`` with the number of the block of its ring ``cell``; the rows of a ring of several parts are dealt out by ``row``."""
    spark = df.sparkSession
    dealt = F.broadcast(spark.createDataFrame(dealt, "__cell int, __block int, __parts int"))
    block = F.col("__block") + F.pmod(F.xxhash64(row), F.col("__parts")).cast("int")
    return df.join(dealt, cell == F.col("__cell"), "left").withColumn(name, block).drop("__cell", "__block", "__parts")


def pivot_topk(
    queries: DataFrame, table: DataFrame, pivots: np.ndarray, k: int = 10, key: str = "vec_id", vector: str = "embedding",
    skip_self: bool = False, block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(query_id, vec_id, score, rank)`` as :func:`cosine_topk` gives it, and ``(query_id, visited, skipped)`` numbers of rings."""
    spark = table.sparkSession
    placed = table.select(F.col(key).alias("vec_id"), F.col(vector).alias("__v"))
    placed = materialize(place_in_rings(placed, pivots, "__v"), "rings")
    rings = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high"))
    rings = materialize(rings, "ring-sizes")
    local = rings.orderBy("cell").toPandas()  # at most pivots x RINGS + 1 rows
    shared = spark.sparkContext.broadcast((pivots, local))
    enough = k + int(skip_self)

    @F.pandas_udf("array<int>")
    def first(vectors: pd.Series) -> pd.Series:
        centers, found = shared.value
        cells, sizes = found["cell"].to_numpy(np.int32), found["n"].to_numpy()
        out, unit = [], unit_rows(vectors)
        for start in range(0, len(unit), _QUERIES):
            for bound in best_scores(unit[start : start + _QUERIES], centers, found):
                order = np.argsort(-bound, kind="stable")
                out.append(cells[order[: int(np.searchsorted(np.cumsum(sizes[order]), enough)) + 1]])
        return pd.Series(out)

    rows = placed.select("vec_id", "__v", "cell")
    asked = materialize(queries.select(F.col(key).alias("query_id"), F.col(vector).alias("__q")).withColumn("seen", first("__q")), "first-rings")
    visits = asked.select("query_id", "__q", F.explode_outer("seen").alias("cell")).filter("cell is not null")
    near = materialize(cell_search(visits, rows, rings, k, skip_self, block_rows).drop("rank"), "first-best")
    floors = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))

    # Blocks of rows, and groups of queries by their first ring: of bounded size, and enough for the cores.
    tasks = math.ceil(math.sqrt(3 * spark.sparkContext.defaultParallelism))

    def deal(sizes: pd.DataFrame) -> pd.DataFrame:
        return _deal(sizes, min(block_rows, max(_LEAST_ROWS, math.ceil(int(sizes["n"].sum()) / tasks))))

    own = F.get("seen", F.lit(0))
    counted = asked.groupBy(own.alias("cell")).agg(F.count(F.lit(1)).alias("n")).filter("cell is not null")
    blocks, groups = deal(local), deal(counted.orderBy("cell").toPandas())
    pieces = [np.arange(b, b + p) for b, p in zip(blocks["block"], blocks["parts"])]
    of_ring = spark.sparkContext.broadcast((np.repeat(np.arange(len(blocks)), blocks["parts"]), np.concatenate([np.empty(0, np.int64), *pieces])))

    @F.pandas_udf("blocks array<int>, more int")
    def others(vectors: pd.Series, seen: pd.Series, least: pd.Series) -> pd.DataFrame:
        centers, found = shared.value
        ring, block = of_ring.value
        reached = _reached(unit_rows(vectors), centers, found, seen, _floors(least))
        return pd.DataFrame({"blocks": [np.unique(block[r[ring]]).astype(np.int32) for r in reached], "more": reached.sum(axis=1).astype(np.int32)})

    def score(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        centers, found = shared.value
        cells, ring = np.unique(v["cell"].to_numpy(), return_inverse=True)
        unit, least = unit_rows(q["__q"]), _floors(q["floor"])
        reached = _reached(unit, centers, found.iloc[np.searchsorted(found["cell"].to_numpy(), cells)], q["seen"], least)
        return _best_above(q["query_id"], unit, least, v["vec_id"], unit_rows(v["__v"]), ring, reached, k, skip_self)

    wider = asked.join(floors, asked["query_id"].eqNullSafe(floors["query_id"]), "left").select(asked["query_id"], "__q", "seen", "floor")
    wider = _in_blocks(wider.withColumn("__o", others("__q", "seen", "floor")), groups, own, "query_id", "__g")
    wider = materialize(wider.select("query_id", "__q", "seen", "floor", "__g", "__o.blocks", "__o.more"), "other-rings")
    left = wider.select("query_id", "__q", "seen", "floor", "__g", F.explode("blocks").alias("__b"))
    met = left.select(F.col("__g").alias("__h"), F.col("__b").alias("__c")).distinct()  # groups x blocks at most
    right = _in_blocks(rows, blocks, F.col("cell"), "vec_id", "__b").join(F.broadcast(met), F.col("__b") == F.col("__c")).drop("__c")
    rest = left.groupBy("__g", "__b").cogroup(right.groupBy("__h", "__b")).applyInPandas(score, _pair_schema(asked, rows))
    visited = F.size("seen") + F.col("more")
    return _rank(near.unionByName(rest), k), wider.select("query_id", visited.alias("visited"), (F.lit(len(local)) - visited).alias("skipped"))
