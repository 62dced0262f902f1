"""Approximate neighbours against the exact join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulith.operators import manifold, neighbor_forest
from tabulith.operators.joins import knn_join


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 12)) + 3 * rng.normal(size=(30, 12))[rng.integers(0, 30, 1500)]
    x[:400] = x[0] + rng.normal(size=(400, 12)) * 0.01  # one hot spot
    x[400:430] = x[400]  # copies
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>").cache()


def test_recall_against_the_exact_join(points):
    found, seen = neighbor_forest.approximate_knn(points, "id", "v", 5, leaf_rows=64, trees=2)
    exact = {(r["src"], r["rank"]): r["distance"] for r in knn_join(points, "id", "v", 5).collect()}
    got = {(r["src"], r["rank"]): r["distance"] for r in found.collect()}
    assert set(got) == set(exact) and seen >= 0.95
    assert all(got[e] >= exact[e] - 1e-12 for e in exact)
    reach = {s: exact[s, 5] for s, _ in exact}
    assert np.mean([got[s, r] <= reach[s] * (1 + 1e-9) for s, r in got]) >= 0.95


def test_few_rows_none_and_an_unreachable_recall(spark, points):
    assert neighbor_forest.approximate_knn(points.limit(0), "id", "v", 3)[0].count() == 0
    two = points.where("id IN (1, 500)")
    assert [tuple(r)[:2] for r in neighbor_forest.approximate_knn(two, "id", "v", 3)[0].orderBy("src").collect()] == [(1, 500), (500, 1)]
    some = points.where("id % 10 = 0")
    found, seen = neighbor_forest.approximate_knn(some, "id", "v", 3, recall=1.1, rounds=1)
    assert seen == 1.0 and found.exceptAll(knn_join(some, "id", "v", 3)).isEmpty()


def test_graph_by_mode(points):
    some = points.where("id >= 1200")
    a, b = (manifold.fuzzy_graph(some, "id", "v", 6, mode=m).agg(F.sum("weight")).first()[0] for m in ("exact", "approximate"))
    assert b == pytest.approx(a, rel=0.02)
    with pytest.raises(ValueError):
        manifold.knn_graph(some, "id", "v", 6, mode="rough")
