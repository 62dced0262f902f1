"""Histogram forests: splits against a plain search, limits on rows, and cuts against separate fits."""

import inspect
from importlib import import_module

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulith import catalog
from tabulith.operators import histogram_forest, search, trees


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(600, 6)), 2)
    x[:200, 2] = 0.5  # a third of all rows in one spot
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(int) + (x[:, 3] > 1)
    data = [(i, int(c), [float(v) for v in r]) for i, (c, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(data, "id int, y int, raw array<double>").withColumn("features", array_to_vector("raw")).repartition(5).cache()
    return df, x, y


def best_plain(x, y, edges):
    """Every edge of every feature; the first of equals."""
    def purity(part):
        return (np.bincount(part, minlength=3) ** 2).sum() / max(len(part), 1)
    best = (-1.0, None, None)
    for f, limits in enumerate(edges):
        for limit in limits:
            gain = round(purity(y[x[:, f] < limit]) + purity(y[x[:, f] >= limit]) - purity(y), 9)
            if gain > best[0]:
                best = (gain, f, limit)
    return best


def test_every_split_of_a_tree_is_the_best(rows):
    df, x, y = rows
    model = trees.decision_tree(df, "y", depth=4, min_leaf=1, min_split=20)
    tree = model.trees[0]
    at = {0: np.arange(len(y))}
    for node, f in enumerate(tree.feature):
        here = at[node]
        assert tree.rows[node] == len(here) and (tree.counts[node] == np.bincount(y[here], minlength=3)).all()
        if f < 0:
            continue
        gain, feature, limit = best_plain(x[here], y[here], model.edges)
        assert len(here) >= 20 and f == feature and model.edges[f][tree.bin[node]] == limit
        assert tree.gain[node] == pytest.approx(gain)
        left = x[here, f] < limit
        at[tree.left[node]], at[tree.left[node] + 1] = here[left], here[~left]
    assert sum(f >= 0 for f in tree.feature) > 3


def test_row_limits_hold_in_every_tree(rows):
    df, *_ = rows
    model = trees.random_forest(df, "y", trees=12, depth=8, min_leaf=4, min_split=30)
    for t in model.trees:
        assert (t.rows[t.feature >= 0] >= 30).all() and (t.rows >= 4).all() and t.depth().max() <= 8
    assert len({tuple(t.feature) for t in model.trees}) > 6


def test_cuts_equal_separate_fits(rows):
    df, *_ = rows
    large = trees.random_forest(df, "y", trees=9, depth=7)
    small = trees.random_forest(df, "y", trees=4, depth=3)
    a = {r["id"]: r["probability"] for r in large.cut(4, 3).transform(df).collect()}
    b = {r["id"]: r["probability"] for r in small.transform(df).collect()}
    assert all(np.allclose(a[i].toArray(), b[i].toArray()) for i in b)
    right = small.transform(df).where(F.col("prediction") == F.col("y")).count() / 600
    assert large.accuracies(df, "y", [(9, 7), (4, 3)])[1] == pytest.approx(right)


def test_histograms_in_several_jobs_change_nothing(rows, monkeypatch):
    df, *_ = rows
    whole = trees.random_forest(df, "y", trees=3, depth=4)
    monkeypatch.setattr(histogram_forest, "CELLS", 4000)
    parts = trees.random_forest(df, "y", trees=3, depth=4)
    for a, b in zip(whole.trees, parts.trees):
        assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and np.allclose(a.counts, b.counts)


def test_search_over_min_split_equals_plain_folds(rows):
    df, *_ = rows
    grid = {"trees": [2, 5], "depth": [2, 4], "min_split": [2, 80]}
    found = search.grid_search_cv(df, ["id"], "y", grid, k=3)
    assert found.count() == 8
    def plain(train, params):
        return search.forest_fit("y")(train, params)
    other = search.grid_search_cv(df, ["id"], "y", grid, k=3, fit=plain)
    key = ["trees", "depth", "min_split", "mean_score", "fold_1", "fold_2", "fold_3"]
    assert sorted(map(tuple, found.select(key).collect())) == sorted(map(tuple, other.select(key).collect()))


def test_gaps_missing_labels_and_weights(spark):
    data = [(1.0, None, 1.0), (None, 1, 1.0), (0.0, 0, 1.0), (0.0, 0, 1.0), (5.0, 1, 1.0), (float("nan"), 1, 2.0), (5.0, 0, 0.0)]
    df = spark.createDataFrame(data, "a double, y int, w double")
    df = df.withColumn("features", F.when(F.col("a").isNotNull(), array_to_vector(F.array("a"))))
    model = trees.decision_tree(df, "y", min_leaf=1, weight="w")
    assert model.trees[0].counts[0].tolist() == [2.0, 3.0] and model.trees[0].rows[0] == 4
    seen = model.transform(df.where("a IS NOT NULL AND y IS NOT NULL AND w > 0"))
    assert seen.where(F.col("prediction") != F.col("y")).count() == 0
    with pytest.raises(ValueError):
        trees.decision_tree(df.limit(0), "y")


def test_a_table_of_one_class_is_one_leaf(spark):
    df = spark.createDataFrame([(float(i),) for i in range(8)], "a double").withColumn("features", array_to_vector(F.array("a")))
    model = trees.random_forest(df.withColumn("y", F.lit(3)), "y", trees=3)
    assert all(len(t.heap) == 1 for t in model.trees)
    assert {r["prediction"] for r in model.transform(df).collect()} == {3.0}


@pytest.mark.parametrize("local", [0, 50, 10_000])
def test_growing_below_small_nodes_in_a_task_changes_nothing(rows, monkeypatch, local):
    df, x, y = rows
    monkeypatch.setattr(histogram_forest, "LOCAL_ROWS", local)
    found = trees.random_forest(df, "y", trees=5, depth=9, min_leaf=2, min_split=6)
    monkeypatch.setattr(histogram_forest, "LOCAL_ROWS", 0)
    plain = trees.random_forest(df, "y", trees=5, depth=9, min_leaf=2, min_split=6)
    for a, b in zip(found.trees, plain.trees):
        at = np.argsort(b.heap)
        for name in ("heap", "feature", "bin", "counts", "rows", "gain"):
            assert np.array_equal(getattr(a, name)[np.argsort(a.heap)], getattr(b, name)[at])
    bins = histogram_forest._bins(x, found.edges)
    assert np.allclose(found.shares(bins), plain.shares(bins))


def test_a_cut_by_rows_is_the_forest_of_that_min_split(rows):
    df, x, y = rows
    bins = histogram_forest._bins(x, trees.random_forest(df, "y", trees=1, depth=1).edges)
    large = trees.random_forest(df, "y", trees=6, depth=8, min_split=2)
    small = trees.random_forest(df, "y", trees=4, depth=6, min_split=40)
    assert np.allclose(large.cut(4, 6, 40).shares(bins), small.shares(bins))
    right = (np.array(small.classes)[small.shares(bins).argmax(1)] == y).mean()
    assert large.accuracies(df, "y", [(6, 8, 2), (4, 6, 40)])[1] == pytest.approx(right)


def test_a_search_grows_one_forest_per_fold_and_min_leaf(rows, monkeypatch):
    df, *_ = rows
    grown = []
    plain = histogram_forest.grow_many
    monkeypatch.setattr(search, "grow_many", lambda *a, **o: grown.append(a[2]) or plain(*a, **o))
    search.grid_search_cv(df, ["id"], "y", {"trees": [2, 4], "depth": [2, 3], "min_split": [2, 9], "min_leaf": [1, 3]}, k=2)
    assert len(grown) == 4 and all(len(limits) == 1 for limits in grown)


def test_kept_forests_cover_the_trials_before(rows, monkeypatch):
    """A forest that is grown anew takes in what was asked before, so that going back grows nothing."""
    df, *_ = rows
    grown, plain, fit, kept = [], histogram_forest.grow_many, search.forest_fit("y"), {}
    trials = [{"trees": 6, "depth": 2}, {"trees": 2, "depth": 5}, {"trees": 6, "depth": 2}, {"trees": 3, "depth": 4, "min_split": 9}]
    alone = [fit.many(df, df, [t])[0] for t in trials]
    monkeypatch.setattr(search, "grow_many", lambda *a, **o: grown.append(a[2]) or plain(*a, **o))
    assert [fit.many(df, df, [t], kept)[0] for t in trials] == pytest.approx(alone)
    assert len(grown) == 2


def test_a_tree_is_grown_as_far_as_its_cuts_need(rows):
    df, *_ = rows
    cuts = [(5, 3, 30), (2, 7, 2), (4, 3, 8)]
    whole = trees.random_forest(df, "y", trees=5, depth=7, min_leaf=1)
    cut = histogram_forest.grow_many(df, "y", [histogram_forest.Limits(5, 7, 2, 1)], cuts=[cuts])[0]
    assert cut.accuracies(df, "y", cuts) == pytest.approx(whole.accuracies(df, "y", cuts))
    assert [t.depth().max() for t in cut.trees] <= [7, 7, 3, 3, 3] and len(cut.trees[4].heap) < len(whole.trees[4].heap)


@pytest.mark.parametrize("name, module, parameters", [
    ("tsne_layout", "manifold", {"iterations": 1000, "exaggerated": 250}), ("bayesian_search_cv", "search", {"n_iter": 20, "n_init": 5, "k": 5}),
    ("run_trees", "modelling", {"sizes": None})])
def test_queries_run_at_the_full_size(spark, monkeypatch, name, module, parameters):
    """As the operators have it by default, not fewer rounds, trials or trees."""
    catalog.load()
    held = getattr(import_module(catalog.QUERIES[name].__module__), module)
    plain, seen = inspect.signature(getattr(held, name)), {}

    def called(*args, **options):
        bound = plain.bind(*args, **options)
        bound.apply_defaults()
        seen.update(bound.arguments)
        return (spark.range(1), {}) if name == "run_trees" else spark.range(1)
    monkeypatch.setattr(held, name, called)
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert {p: seen[p] for p in parameters} == parameters
