"""Pivot-bounded search against the exact scan, and the rings it skips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import pivots as pv
from strandline.operators import similarity as sim
from strandline.session import materialize

from .test_cellindex import clustered


def rows(df):
    return {(r["query_id"], r["vec_id"], r["rank"], round(r["score"], 9)) for r in df.collect()}


@pytest.mark.parametrize("skip_self", [True, False])
def test_equals_the_exact_scan_and_skips_on_clusters(spark, skip_self):
    table = materialize(clustered(spark), "vectors")  # equal vectors, a zero vector, a cluster of a third of all rows
    some = table.filter("vec_id % 10 = 0 or vec_id = 9")
    found, visits = pv.pivot_topk(some, table, sim.train_cells(table, 24), 7, skip_self=skip_self, block_rows=300)
    assert rows(found) == rows(sim.cosine_topk(some, table, 7, skip_self=skip_self))
    counted = visits.agg(F.sum("visited"), F.sum("skipped"), F.count("*")).first()
    assert counted[2] == some.count() and counted[1] > counted[0]  # more than half of the rings are left out


def test_bounds_hold():
    rng = np.random.default_rng(1)
    unit = sim.unit_rows(list(rng.normal(size=(300, 6))))
    centers = sim.unit_rows(list(rng.normal(size=(5, 6))))
    far = pv._distances(unit, centers)
    own = far.argmin(axis=1)
    dist = far[np.arange(300), own]
    cell = own * pv.RINGS + np.minimum((dist / pv._WIDTH).astype(int), pv.RINGS - 1)
    import pandas as pd

    rings = pd.DataFrame({"cell": cell, "dist": dist}).groupby("cell", as_index=False).agg(low=("dist", "min"), high=("dist", "max"))
    bound = pv.best_scores(unit, centers, rings)
    scores = unit @ unit.T
    for place, c in enumerate(rings["cell"]):
        assert (scores[:, cell == c].max(axis=1) <= bound[:, place] + 1e-9).all()


def test_few_rows_and_empty_inputs(spark):
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [0.5, 0.5])], "vec_id string, embedding array<float>")
    centers = np.array([[1.0, 0.0]])
    found, visits = pv.pivot_topk(table, table, centers, 5)
    assert rows(found) == rows(sim.cosine_topk(table, table, 5))
    assert {r["skipped"] for r in visits.collect()} == {0}
    assert pv.pivot_topk(table.limit(0), table, centers, 5)[0].count() == 0 and pv.pivot_topk(table, table.limit(0), centers, 5)[0].count() == 0


def test_without_clusters_queries_do_not_travel_once_a_ring(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows_in = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(3000, 24)))]
    table = materialize(spark.createDataFrame(rows_in, "vec_id bigint, embedding array<double>").repartition(4), "vectors")
    sent, search = [], pv.cell_search
    monkeypatch.setattr(pv, "cell_search", lambda probes, *rest: sent.append(probes.count()) or search(probes, *rest))
    found, visits = pv.pivot_topk(table, table, sim.train_cells(table, 8), 5, skip_self=True, block_rows=700)
    assert rows(found) == rows(sim.cosine_topk(table, table, 5, skip_self=True))
    visited = visits.agg(F.sum("visited")).first()[0]
    assert visited > 20 * 3000 and sum(sent) < visited / 5


@pytest.mark.parametrize("skip_self", [True, False])
def test_best_of_a_block_among_allowed_rings(skip_self):
    rng = np.random.default_rng(5)
    unit = sim.unit_rows(list(rng.normal(size=(2600, 12))))
    unit[::3] = unit[0]  # copies: ties by id
    unit[7] = 0
    ids, ring = rng.permutation(2600), rng.integers(0, 9, 2600)
    asked = np.r_[0:1100:2, 7]
    floors = np.where(rng.random(len(asked)) < 0.3, -np.inf, rng.uniform(0.1, 0.9, len(asked)))
    allowed = rng.random((len(asked), 9)) < 0.7
    allowed[3] = False
    found = pv._best_above(ids[asked], unit[asked], floors, ids, unit, ring, allowed, 6, skip_self)
    got = {q: list(zip(g["vec_id"], g["score"])) for q, g in found.sort_values(["score", "vec_id"], ascending=[False, True]).groupby("query_id")}
    scores = np.round(unit[asked] @ unit.T, 12)
    for place, row in enumerate(asked):
        fits = allowed[place, ring] & (scores[place] >= floors[place])
        if skip_self:
            fits[row] = False
        want = sorted(zip(-scores[place, fits], ids[fits]))[:6]
        have = got.get(ids[row], [])
        assert [v for _, v in want] == [v for v, _ in have] and np.allclose([-s for s, _ in want], [s for _, s in have])


def test_rings_are_dealt_to_blocks_of_bounded_size():
    import pandas as pd

    dealt = pv._deal(pd.DataFrame({"cell": [2, 3, 5, 6, 9], "n": [4, 5, 25, 3, 7]}), 10)
    assert dealt.values.tolist() == [[2, 0, 1], [3, 0, 1], [5, 1, 3], [6, 4, 1], [9, 4, 1]]
