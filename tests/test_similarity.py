import math
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import similarity as sim


def vectors(spark, n=400, dim=16, seed=5):
    """A third of the rows are copies of one vector: one hot cell, and ties everywhere in it."""
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, dim))
    matrix[::3] = matrix[0]
    matrix[7] = 0.0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5), matrix.astype(np.float32)


def brute_force(matrix, k, skip_self):
    m = matrix.astype(np.float64)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
    scores = np.round(m @ m.T, 9)
    out = set()
    for q in range(len(m)):
        ids = [i for i in range(len(m)) if not (skip_self and i == q)]
        for rank, i in enumerate(sorted(ids, key=lambda i: (-scores[q, i], i))[:k], 1):
            out.add((q, i, rank))
    return out


@pytest.mark.parametrize("skip_self", [True, False])
def test_all_exact_paths_agree_with_brute_force(spark, skip_self):
    table, matrix = vectors(spark)
    expected = brute_force(matrix, 7, skip_self)
    cells = sim.train_cells(table, 6)
    results = [
        sim.cosine_topk(table, table, 7, skip_self=skip_self),
        sim.cosine_topk(table, table, 7, skip_self=skip_self, max_values=100, block_rows=60),
        sim.ivf_topk(table, table, cells, 7, nprobe=len(cells), skip_self=skip_self, block_rows=50),
    ]
    for found in results:
        assert {(r["query_id"], r["vec_id"], r["rank"]) for r in found.collect()} == expected


def test_hot_cell_is_cut_into_bounded_blocks(spark):
    table, _ = vectors(spark)
    cells = sim.train_cells(table, 6)
    sizes = sim.ivf_assign(table, cells).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert sizes > 130  # the copies share a cell
    found = sim.ivf_topk(table, table, cells, 5, nprobe=2, block_rows=20)
    assert found.groupBy("query_id").count().filter("count <> 5").isEmpty()


def test_ivf_recall(spark, table):
    stored = table("embeddings")
    exact = sim.cosine_topk(stored, stored, 10)
    cells = sim.train_cells(stored, 16)
    found = sim.ivf_topk(stored, stored, cells, 10, nprobe=8)
    assert sim.recall_at_k(found, exact).first()["recall"] > 0.8


def test_no_cartesian_product(spark, table):
    stored = table("embeddings")
    for found in (sim.cosine_topk(stored, stored, 3), sim.cosine_topk(stored, stored, 3, max_values=64)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan and plan.count("WindowGroupLimit") == 2


def test_fewer_rows_than_k_and_empty_inputs(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert [(r["vec_id"], r["rank"]) for r in sim.cosine_topk(one, one, 5).collect()] == [(1, 1)]
    assert sim.cosine_topk(one, one, 5, skip_self=True).count() == 0
    assert sim.cosine_topk(one.limit(0), one, 5).count() == 0


def test_small_blocks_share_the_copies_of_rows(spark):
    rows = spark.range(3_000).select(F.col("id").alias("vec_id"), F.array(F.cos("id"), F.sin("id")).alias("embedding"))
    found = sim.cosine_topk(rows, rows, 3, skip_self=True, max_values=2, block_rows=10)
    cuts = [int(n) + 1 for n in re.findall(r"sequence\(cast\(0 as bigint\), cast\((\d+) as bigint\)", found._jdf.queryExecution().analyzed().toString())]
    assert len(cuts) == 2 and max(cuts) <= math.ceil(math.sqrt(3 * spark.sparkContext.defaultParallelism))
    assert found.count() == 9_000


def test_unit_rows_hold_little_beside_the_matrix():
    vectors = [np.ones(64, np.float32) for _ in range(40_000)]
    tracemalloc.start()
    matrix = sim.unit_rows(vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * matrix.nbytes


def test_queries_in_several_slabs_give_all_best_rows(spark):
    at = np.arange(sim.SLAB + 500) * 0.001
    queries = spark.createDataFrame([(i, [math.cos(a), math.sin(a)]) for i, a in enumerate(at.tolist())], "vec_id bigint, embedding array<double>")
    found = sim.cosine_topk(queries, queries.filter("vec_id % 300 = 0").repartition(3), 2)
    best = {r["query_id"]: r["vec_id"] for r in found.filter("rank = 1").collect()}
    assert len(best) == len(at) and all(best[i] == i for i in range(0, len(at), 300))


def test_vectors_of_other_lengths_fail():
    with pytest.raises(ValueError):
        sim.unit_rows([[1.0, 2.0], [1.0]])


def test_scores_of_a_block_are_held_in_pieces():
    rng = np.random.default_rng(3)
    q, v = (sim.unit_rows(rng.normal(size=(n, 8))) for n in (2500, 2000))
    tracemalloc.start()
    found = sim._best_pairs(np.arange(2500), q, np.arange(2000), v, 3, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6  # 40 MB are all scores
    scores = np.round(q @ v.T, 12)
    scores[np.arange(2000), np.arange(2000)] = -np.inf
    want = {(i, j) for i in range(2500) for j in np.lexsort((np.arange(2000), -scores[i]))[:3].tolist()}
    assert set(zip(found["query_id"].tolist(), found["vec_id"].tolist())) == want
