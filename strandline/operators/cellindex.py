"""A stored cell index over vectors: built once, added to, searched by reading the probed cells only.

Layout below ``path``: ``cells`` (the centroids), ``d=<n>/cell=<c>`` (vectors, one folder per addition, partitioned by cell),
``sizes/d=<n>`` (rows per cell) and the commit log that says which additions are complete. Searches
join the table with the few cells they probe, so Spark prunes the partitions of all others at run time.

The number of probes is calibrated: for a sample of stored vectors the exact neighbours are found, and the least number is
taken whose share of these lies in the probed cells with a margin over the wanted recall.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.similarity import BLOCK_ROWS, cell_search, cosine_topk, ivf_assign, nearest_cells, train_cells
from strandline.session import materialize
from strandline.sources.commits import CommitLog, create_once, read_text

#: Rows that the centroids are trained on at most; every row is indexed all the same.
TRAIN_ROWS = 1_000_000
#: Vectors whose exact neighbours the calibration looks up.
SAMPLE = 1_000


def build_index(
    table: DataFrame, path: str, nlist: int = 128, key: str = "vec_id", vector: str = "embedding", train_rows: int = TRAIN_ROWS, seed: int = 7
) -> None:
    """Train the cells and store all rows of ``table``; the path must be new."""
    spark = table.sparkSession
    rows = table.count()
    cells = train_cells(table, min(nlist, max(2, rows)), vector, seed, fraction=min(1.0, train_rows / max(1, rows)))
    stored = [(i, [float(x) for x in c]) for i, c in enumerate(cells)]
    spark.createDataFrame(stored, "cell int, center array<double>").coalesce(1).write.parquet(f"{path.rstrip('/')}/cells")
    add_vectors(table, path, key, vector)


def read_cells(spark: SparkSession, path: str) -> np.ndarray:
    """The centroids, at most ``nlist`` rows."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/cells").orderBy("cell").collect()
    return np.array([r["center"] for r in rows])


def add_vectors(table: DataFrame, path: str, key: str = "vec_id", vector: str = "embedding") -> int:
    """Assign new rows to the stored cells and publish them; returns the addition's number. Nothing stored is rewritten.

    A vector of an indexed key is a further row: remove old keys before, or build anew.
    """
    spark, base = table.sparkSession, path.rstrip("/")
    log = CommitLog(spark, base)
    number = log.claim()
    placed = ivf_assign(table.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector")), read_cells(spark, base), "vector")
    # rebalancing by cell gives small cells one file and cuts a hot one into several
    placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(log.folder("d", number))
    written = spark.read.schema("vec_id string, cell int").parquet(log.folder("d", number))
    written.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{base}/sizes/d={number:08d}")
    log.add(number)
    return number


def _additions(log: CommitLog) -> list[str]:
    return [f"d={a['number']:08d}" for a in log.state()[1]]


def stored_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(vec_id, vector, cell)`` of all complete additions, partitioned by cell."""
    base = path.rstrip("/")
    found = _additions(CommitLog(spark, base))
    return spark.read.option("basePath", base).parquet(*[f"{base}/{d}" for d in found]).select("vec_id", "vector", "cell")


def cell_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(cell, n)``; at most ``nlist`` rows, without touching the vectors."""
    base = path.rstrip("/")
    found = _additions(CommitLog(spark, base))
    return spark.read.parquet(*[f"{base}/sizes/{d}" for d in found]).groupBy("cell").agg(F.sum("n").alias("n"))


def search_index(
    queries: DataFrame, path: str, k: int = 10, nprobe: int | None = None, key: str = "vec_id", vector: str = "embedding",
    skip_self: bool = False, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, vec_id, score, rank)`` among the ``nprobe`` nearest cells (the calibrated number by default)."""
    spark = queries.sparkSession
    cells = read_cells(spark, path)
    nprobe = nprobe or calibration(spark, path)["nprobe"]
    probes = ivf_assign(queries.select(F.col(key).alias("query_id"), F.col(vector).alias("__q")), cells, "__q", min(nprobe, len(cells)))
    probes = materialize(probes, "probes")
    return cell_search(probes, probed_vectors(probes, path), cell_sizes(spark, path), k, skip_self, block_rows)


def probed_vectors(probes: DataFrame, path: str) -> DataFrame:
    """The stored vectors of the cells in ``probes``; other partitions are pruned when the scan starts."""
    # A comparison, since Spark prunes by a side that filters; no cell is below 0.
    wanted = probes.select("cell").where("cell >= 0").distinct()
    stored = stored_vectors(probes.sparkSession, path)
    return stored.join(F.broadcast(wanted), "cell", "left_semi").select("vec_id", F.col("vector").alias("__v"), "cell")


def calibrate(spark: SparkSession, path: str, k: int = 10, target: float = 0.9, sample: int = SAMPLE, margin: float = 2.0) -> dict:
    """Store and return the least ``nprobe`` whose recall on a sample is ``target`` plus ``margin`` standard errors.

    The sample is the ``sample`` stored vectors of least key hash; their exact neighbours come from a scan of all vectors.
    A pair is found with ``nprobe`` cells if the neighbour's cell is among the query's nearest that many, so one
    pass gives the recall of every number of probes.
    """
    cells = read_cells(spark, path)
    stored = stored_vectors(spark, path)
    asked = materialize(stored.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec_id", "vector"), "sample")
    exact = materialize(cosine_topk(asked, stored, k, vector="vector", skip_self=True).select("query_id", "vec_id"), "exact")
    order = asked.select(F.col("vec_id").alias("query_id"), nearest_cells(spark, cells, len(cells))("vector").alias("order"))
    # sample * k pairs and sample lists of nlist numbers: bounded by the parameters
    pairs = stored.select("vec_id", "cell").join(F.broadcast(exact), "vec_id").join(F.broadcast(order), "query_id")
    places = pairs.groupBy(F.array_position("order", F.col("cell")).alias("place")).count().collect()
    counts = np.zeros(len(cells) + 1)
    for row in places:
        counts[row["place"]] += row["count"]
    total = max(1.0, counts.sum())
    recall = counts.cumsum() / total
    enough = [n for n in range(1, len(cells) + 1) if recall[n] >= min(1.0, target + margin * math.sqrt(max(0.0, recall[n] * (1 - recall[n])) / total))]
    nprobe = enough[0] if enough else len(cells)
    found = {"nprobe": int(nprobe), "nlist": len(cells), "recall": float(recall[nprobe]), "target": target, "k": k, "sample": sample}
    number = 1
    while not create_once(spark, f"{path.rstrip('/')}/_log/calibration-{number:08d}", json.dumps(found)):
        number += 1
    return found


def calibration(spark: SparkSession, path: str) -> dict:
    """The latest stored calibration; raises where there is none."""
    names = sorted(n for n in CommitLog(spark, path)._names() if n.startswith("calibration-") and n[12:].isdigit())
    if not names:
        raise ValueError(f"{path}: calibrate the index or give nprobe")
    return json.loads(read_text(spark, f"{path.rstrip('/')}/_log/{names[-1]}"))
