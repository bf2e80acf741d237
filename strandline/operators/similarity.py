"""Cosine top-k over stored vectors: exact scan, block grid, and coarse-cell probing."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.session import materialize

# Queries sent to every task as one matrix: at most this many float64 values (128 MB).
BROADCAST_VALUES = 16_000_000
# Rows of one block of the grid or of one salted cell.
BLOCK_ROWS = 50_000
# Values of one side of a grid cell: blocks smaller than this travel together, so that rows are not copied once for each of them.
CELL_VALUES = 64 * BLOCK_ROWS
# Scores of a block that are held at once (8 MB, and twice as much for ranking them).
SCORES = 1_000_000
# Queries whose best rows are merged at once; the others' stay as they are meanwhile.
SLAB = 8_192


def unit_rows(vectors) -> np.ndarray:
    """Vectors as the rows of a matrix, scaled to length 1; zero vectors stay."""
    vectors = list(vectors)
    if not vectors:
        return np.empty((0, 0))
    matrix = np.empty((len(vectors), np.size(vectors[0])))
    for row, vector in zip(matrix, vectors, strict=True):
        if np.shape(vector) != row.shape:
            raise ValueError(f"a vector of shape {np.shape(vector)} among those of length {len(row)}")
        row[:] = vector
    if matrix.size == 0:
        return matrix.reshape(0, 0)
    # in pieces, so that no square or quotient of the whole matrix is held beside it
    for piece in (matrix[i : i + 4096] for i in range(0, len(matrix), 4096)):
        norms = np.sqrt((piece**2).sum(axis=1, keepdims=True))
        np.divide(piece, norms, out=piece, where=norms > 0)
        piece[~(norms[:, 0] > 0)] = 0.0
    return matrix


def _best_pairs(query_ids, queries: np.ndarray, ids, vectors: np.ndarray, k: int, skip_self: bool) -> pd.DataFrame:
    """The k best rows of one block for each query, ties by id; never all pairs.

    Scores are rounded to 12 decimals so that equal vectors tie exactly whatever
    order the products were summed in.
    """
    ids, query_ids = np.asarray(ids), np.asarray(query_ids)
    parts = [(query_ids[:0], ids[:0], np.empty(0))]
    step = max(1, SCORES // max(1, len(ids)))
    for start in range(0, len(query_ids), step):
        mine = query_ids[start : start + step]
        scores = queries[start : start + step] @ vectors.T
        np.round(scores, 12, out=scores)
        if skip_self:
            scores[mine[:, None] == ids[None, :]] = -np.inf
        cut = min(k, len(ids))
        floor = np.partition(scores, len(ids) - cut, axis=1)[:, len(ids) - cut]
        q, v = np.nonzero((scores >= floor[:, None]) & np.isfinite(scores))
        keep = _first_k(q, ids[v], scores[q, v], k)
        q, v = q[keep], v[keep]
        parts.append((mine[q], ids[v], scores[q, v]))
    return pd.DataFrame({c: np.concatenate(p) for c, p in zip(("query_id", "vec_id", "score"), zip(*parts))})


def _first_k(groups: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries of each group, by falling score, then id."""
    order = np.lexsort((ids, -scores, groups))
    ranked = groups[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, dtype=np.int64)
    place = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.r_[starts, len(ranked)]))
    return order[place < k]


def _merge(best: pd.DataFrame | None, more: pd.DataFrame, k: int) -> pd.DataFrame:
    if best is None:
        return more
    both = pd.concat([best, more], ignore_index=True)
    keep = _first_k(pd.factorize(both["query_id"])[0], both["vec_id"].to_numpy(), both["score"].to_numpy(), k)
    return both.iloc[keep]


def _rank(pairs: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def cosine_topk(
    queries: DataFrame,
    table: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    skip_self: bool = False,
    max_values: int = BROADCAST_VALUES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact ``(query_id, vec_id, score, rank)``: the k most similar rows for each query.

    Query sets of checked size travel to the tasks as one matrix and the table is
    scanned once, unshuffled; each input partition emits at most k rows per query.
    Larger sets use a block grid (:func:`_grid_topk`).
    """
    queries = queries.select(F.col(key).alias("query_id"), F.col(vector).alias("__q"))
    table = table.select(F.col(key).alias("vec_id"), F.col(vector).alias("__v"))
    first = queries.select(F.size("__q").alias("n")).first()
    dim = max(1, first["n"] if first else 1)
    bound = max(1, max_values // dim)
    if queries.limit(bound + 1).count() > bound:
        return _rank(_grid_topk(queries, table, k, skip_self, block_rows, dim), k)
    local = queries.toPandas()
    shared = table.sparkSession.sparkContext.broadcast((local["query_id"].to_numpy(), unit_rows(local["__q"])))

    def score(batches):
        query_ids, matrix = shared.value
        starts = range(0, len(query_ids), SLAB)
        best: dict[int, pd.DataFrame] = {}
        for batch in batches:
            if len(batch) and len(query_ids):
                ids, vectors = batch["vec_id"].to_numpy(), unit_rows(batch["__v"])
                for at in starts:
                    found = _best_pairs(query_ids[at : at + SLAB], matrix[at : at + SLAB], ids, vectors, k, skip_self)
                    best[at] = _merge(best.get(at), found, k)
        for at in list(best):
            yield best.pop(at)

    return _rank(table.mapInPandas(score, _pair_schema(queries, table)), k)


def _pair_schema(queries: DataFrame, table: DataFrame) -> str:
    return (
        f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
        f"vec_id {table.schema['vec_id'].dataType.simpleString()}, score double"
    )


def _grid_topk(queries: DataFrame, table: DataFrame, k: int, skip_self: bool, block_rows: int, dim: int) -> DataFrame:
    """Both sides in hashed blocks; each grid cell is one bounded matrix product.

    Every row is copied to as many cells as the other side has blocks. So blocks of ``block_rows`` are joined as far as a side of a cell holds
    ``CELL_VALUES`` and the cells are enough for the cores; inside a cell the product is made a bounded number of scores at a time.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism

    def cuts(n: int) -> int:
        bounded = math.ceil(n / max(block_rows, CELL_VALUES // dim))
        return max(1, bounded, min(math.ceil(n / block_rows), math.ceil(math.sqrt(3 * cores))))

    rows, columns = cuts(queries.count()), cuts(table.count())
    left = queries.withColumn("__r", F.pmod(F.xxhash64("query_id"), F.lit(rows))).withColumn(
        "__c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(columns - 1).cast("bigint")))
    )
    right = table.withColumn("__c", F.pmod(F.xxhash64("vec_id"), F.lit(columns))).withColumn(
        "__r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(rows - 1).cast("bigint")))
    )

    def score(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _best_pairs(q["query_id"], unit_rows(q["__q"]), v["vec_id"], unit_rows(v["__v"]), k, skip_self)

    grouped = left.groupBy("__r", "__c").cogroup(right.groupBy("__r", "__c"))
    return grouped.applyInPandas(score, _pair_schema(queries, table))


def train_cells(
    table: DataFrame,
    nlist: int = 128,
    vector: str = "embedding",
    seed: int = 7,
    max_iter: int = 10,
    fraction: float = 1.0,
) -> np.ndarray:
    """Coarse centroids (unit length) by distributed k-means; ``nlist`` rows by ``dim``.

    ``fraction`` trains on a random share of a very large table. It moves the
    centroids only: every vector is still assigned to a cell.
    """
    table = table.sample(fraction=fraction, seed=seed) if fraction < 1.0 else table
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    # Cosine distance is undefined for zero vectors; they still get assigned to a cell.
    usable = table.filter(F.exists(vector, lambda x: x != 0))
    points = usable.select(array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter, distanceMeasure="cosine").fit(points)
    return unit_rows(model.clusterCenters())


def nearest_cells(spark, cells: np.ndarray, probes: int):
    """An Arrow UDF: the numbers of a vector's ``probes`` nearest cells, nearest first."""
    shared = spark.sparkContext.broadcast(cells)

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        scores = unit_rows(vectors) @ shared.value.T
        return pd.Series(list(np.argsort(-scores, axis=1, kind="stable")[:, :probes].astype(np.int32)))

    return nearest


def ivf_assign(table: DataFrame, cells: np.ndarray, vector: str = "embedding", probes: int = 1) -> DataFrame:
    """One row per vector and each of its ``probes`` nearest cells (column ``cell``)."""
    nearest = nearest_cells(table.sparkSession, cells, probes)
    # Outer, so that the optimizer adds no non-empty check that runs the UDF again.
    return table.withColumn("cell", F.explode_outer(nearest(F.col(vector)))).filter("cell is not null")


def ivf_topk(
    queries: DataFrame,
    table: DataFrame,
    cells: np.ndarray,
    k: int = 10,
    nprobe: int = 8,
    key: str = "vec_id",
    vector: str = "embedding",
    skip_self: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Top-k among the ``nprobe`` nearest cells; with all cells probed it is exact.

    A cell is cut into hashed blocks sized by its row count, and a query visits
    every block of its cells, so a cell holding a third of the table is spread
    over many tasks with no candidate left out.
    """
    queries = queries.select(F.col(key).alias("query_id"), F.col(vector).alias("__q"))
    table = table.select(F.col(key).alias("vec_id"), F.col(vector).alias("__v"))
    placed = ivf_assign(table, cells, "__v")
    placed = materialize(placed, "cells")  # assigned once, used for sizes and candidates
    probes = materialize(ivf_assign(queries, cells, "__q", min(nprobe, len(cells))), "probes")
    return cell_search(probes, placed, placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), k, skip_self, block_rows)


def cell_search(probes: DataFrame, placed: DataFrame, sizes: DataFrame, k: int, skip_self: bool, block_rows: int) -> DataFrame:
    """Top-k of ``probes`` (query_id, __q, cell) among the rows of ``placed`` (vec_id, __v, cell) in the same cell; ``sizes``: cell, n."""
    # At most one row per cell: the number of cells bounds this table.
    blocks = F.broadcast(sizes.select("cell", F.ceil(F.col("n") / F.lit(block_rows)).alias("__n")))
    right = placed.join(blocks, "cell").withColumn("__b", F.pmod(F.xxhash64("vec_id"), F.col("__n"))).drop("__n")
    probes = probes.join(blocks, "cell")
    query_blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1))
    # The same split keeps a block that very many queries visit bounded as well.
    visits = probes.withColumn("__b", query_blocks).drop("__n")
    per_block = visits.groupBy("cell", "__b").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("__m"))
    left = visits.join(per_block, ["cell", "__b"]).withColumn("__s", F.pmod(F.xxhash64("query_id"), F.col("__m"))).drop("__m")
    right = right.join(per_block, ["cell", "__b"]).withColumn(
        "__s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__m") - 1))
    ).drop("__m")

    def score(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _best_pairs(q["query_id"], unit_rows(q["__q"]), v["vec_id"], unit_rows(v["__v"]), k, skip_self)

    keys = ["cell", "__b", "__s"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, _pair_schema(probes, placed))
    return _rank(pairs, k)


def recall_at_k(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact pairs that were found."""
    hit = F.lit(1).alias("__hit")
    joined = exact.select("query_id", "vec_id").join(
        found.select("query_id", "vec_id", hit), ["query_id", "vec_id"], "left"
    )
    return joined.agg((F.count("__hit") / F.count(F.lit(1))).alias("recall"))
