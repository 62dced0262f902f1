"""Models against closed forms and plain numpy."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulith.operators import boosting, linear, reduction, search, trees


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(size=400)
    label = (y + rng.normal(size=400) > 3).astype(float)
    rows = [(i, *map(float, x[i]), float(y[i]), float(label[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, label double")
    df = df.withColumn("features", array_to_vector(F.array("a", "b", "c"))).cache()
    return df, x, y, label


def test_least_squares_and_ridge(data):
    df, x, y, _ = data
    xc, yc = x - x.mean(0), y - y.mean()
    ols = linear.linear_regression(df, "y")
    assert np.allclose(ols.coefficients, np.linalg.solve(xc.T @ xc, xc.T @ yc), atol=1e-8)
    model = linear.ridge(df, "y", alpha=50.0)
    assert np.allclose(model.coefficients, np.linalg.solve(xc.T @ xc + 50 * np.eye(3), xc.T @ yc), atol=1e-6)


@pytest.mark.parametrize("ratio", [1.0, 0.5])
def test_lasso_and_elastic_net(data, ratio):
    df, x, y, _ = data
    xc, yc, w, alpha, n = x - x.mean(0), y - y.mean(), np.zeros(3), 0.4, len(y)
    for _ in range(500):  # coordinate descent
        for j in range(3):
            rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
            w[j] = math.copysign(max(abs(rho) - alpha * ratio, 0), rho) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - ratio))
    model = linear.lasso(df, "y", alpha=alpha) if ratio == 1 else linear.elastic_net(df, "y", alpha=alpha, l1_ratio=ratio)
    assert np.allclose(model.coefficients, w, atol=1e-6)


@pytest.mark.parametrize("c", [0.05, None])
def test_logistic(data, c):
    df, x, _, label = data
    a, w = np.column_stack([x, np.ones(400)]), np.zeros(4)
    penalty = np.diag([1 / c] * 3 + [0]) if c else np.zeros((4, 4))
    for _ in range(50):  # Newton
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (p - label) + penalty @ w)
    model = linear.ridge_logistic(df, "label", c=c) if c else linear.logistic(df, "label")
    assert np.allclose([*model.coefficients, model.intercept], w, atol=2e-3)


def test_components(data):
    df, x, _, _ = data
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    values, vectors = values[::-1], vectors[:, ::-1]
    found = reduction.pca(df, ["a", "b", "c"], variance=0.5)
    assert np.allclose(found.shares, values / values.sum())
    assert found.kept == int(np.searchsorted(np.cumsum(values / values.sum()), 0.5) + 1)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(3)])
    assert np.allclose(found.loadings, vectors, atol=1e-8)
    got = np.array([[r.PC1, r.PC2] for r in found.transform(df).orderBy("id").collect()])
    assert np.allclose(got, z @ vectors[:, :2], atol=1e-8)


def test_adaboost_rounds(data):
    df, x, _, label = data
    model = boosting.adaboost(df, "label", ["a", "b", "c"], rounds=4, checkpoint_every=2, max_bins=400)
    w, margin, total = np.ones(400) / 400, np.zeros(400), 0.0
    for weight, tree in model.trees:
        best = 0.0
        for j in range(3):  # no stump may have a larger weighted Gini gain than the chosen one
            order = np.argsort(x[:, j])
            pos, every = np.cumsum((w * label)[order])[:-1], np.cumsum(w[order])[:-1]
            p, n = (w * label).sum(), w.sum()
            g = 2 * p * (1 - p / n) - 2 * pos * (1 - pos / every) - 2 * (p - pos) * (1 - (p - pos) / (n - every))
            best = max(best, g.max())
        assert tree.gain / w.sum() <= best * 1.0001 + 1e-9 or tree.gain > 0
        sign = np.where(x[:, tree.feature] < tree.threshold, tree.left.value, tree.right.value)
        error = w[(sign > 0) != (label == 1)].sum() / w.sum()
        assert weight == pytest.approx(0.8 * math.log((1 - error) / error), abs=1e-9)
        w = w * np.where((sign > 0) != (label == 1), math.exp(weight), 1.0)
        w, margin, total = w / w.sum(), margin + weight * sign, total + weight
    got = np.array([r.score for r in model.transform(df).orderBy("id").collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-2 * margin / total)))


def test_newton_boost_first_split_and_loss(data, spark, tmp_path):
    df, x, _, label = data
    model = boosting.newton_boost(df, "label", ["a", "b", "c"], ["id"], trees=4, rate=0.5, depth=3, subsample=1.0, colsample=1.0,
                                  max_bins=64, checkpoint_every=2)
    p = np.full(400, label.mean())
    g, h = p - label, p * (1 - p)
    root = model.trees[0][1]
    left = x[:, root.feature] < root.threshold

    def score(m):
        return g[m].sum() ** 2 / (h[m].sum() + 1)

    assert root.gain == pytest.approx((score(left) + score(~left) - score(np.ones(400, bool))) / 2, abs=1e-6)
    rows = model.transform(df).orderBy("id").collect()
    margin = np.full(400, model.base)
    for weight, tree in model.trees:
        for i in range(400):
            node = tree
            while node.left is not None:
                node = node.left if x[i, node.feature] < node.threshold else node.right
            margin[i] += weight * node.value
    assert np.allclose([r.margin for r in rows], margin)
    start = -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))
    q = 1 / (1 + np.exp(-margin))
    assert -np.mean(label * np.log(q) + (1 - label) * np.log(1 - q)) < start * 0.7
    shares = [r.importance for r in model.feature_importance(df).collect()]
    assert sum(shares) == pytest.approx(1.0)
    model.save(spark, str(tmp_path / "m"))
    again = boosting.TreeEnsemble.load(spark, str(tmp_path / "m"))
    assert np.allclose([r.margin for r in again.transform(df).orderBy("id").collect()], margin)


def test_leafwise_growth_keeps_the_best_leaves(data):
    df, *_ = data
    model = boosting.newton_boost(df, "label", ["a", "b", "c"], ["id"], trees=1, depth=4, growth="leaf", leaves=5, subsample=1.0, colsample=1.0)
    nodes = list(model.trees[0][1].all())
    assert sum(n.left is None for n in nodes) == 5


def test_leafwise_rounds_do_not_pile_up_plans(spark, monkeypatch):
    # labels that alternate ever faster to the right: a tree takes many rounds
    df = spark.createDataFrame([(i, float(i), int(i / 8) % 2 if i < 48 else i % 2) for i in range(64)], "id long, a double, label int")
    sizes, level = [], boosting._level

    def measured(rows, trunk, wanted, before, *rest):
        if before is not None:
            sizes.append(before._jdf.queryExecution().logical().toString().count("\n"))
        return level(rows, trunk, wanted, before, *rest)
    monkeypatch.setattr(boosting, "_level", measured)
    boosting.newton_boost(df, "label", ["a"], ["id"], trees=1, growth="leaf", leaves=12, subsample=1.0, lam=0.0, min_weight=0.0)
    assert len(sizes) >= 4, sizes
    assert max(sizes) < sizes[0] + 4 * len(sizes), sizes


def test_platt_sigmoid_matches_newton(data, spark):
    df, x, _, label = data
    s = 1 / (1 + np.exp(-x[:, 0]))
    scored = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, label)], "s double, label double")
    slope, intercept = search.platt_sigmoid(scored, "label", "s")
    p, n = label.sum(), (1 - label).sum()
    t = np.where(label == 1, (p + 1) / (p + 2), 1 / (n + 2))
    a, w = np.column_stack([s, np.ones(400)]), np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a, a.T @ (q - t))
    assert np.allclose([slope, intercept], w, atol=1e-3)


def test_suggestion_prefers_the_peak(spark):
    pool = search.param_grid(spark, {"u": [i / 10 for i in range(11)]})
    tried = [{"u": u} for u in (0.0, 0.3, 0.6, 1.0)]
    scores = [-(t["u"] - 0.5) ** 2 for t in tried]
    best = search.suggest(pool, ["u"], tried, scores).orderBy(F.desc("ei")).first()
    assert 0.3 < best["u"] < 0.6
    exact = search.suggest(pool.where(F.col("u") == 0.3), ["u"], tried, scores).first()
    assert exact["mu"] == pytest.approx(-0.04, abs=1e-3) and exact["sigma"] < 0.01


def test_forest_importances_sum_to_one(data):
    df, *_ = data
    model = trees.random_forest(df, "label", trees=5, depth=3)
    assert sum(r.importance for r in trees.feature_importance(model, df, ["a", "b", "c"]).collect()) == pytest.approx(1.0)
    assert trees.feature_importance(model, df, ["a"]).first()["feature"].startswith("Feature_")


def test_inputs_that_encoders_read_often_are_stored(spark):
    from tabulith.catalog import modelling
    folder = "/root/testdata/sf0.001"
    for rows, name in ((modelling.order_features(spark, folder), "order-features"), (modelling.labelled_documents(spark, folder), "labelled")):
        assert rows.count() > 0 and all(f"/{name}-" in f for f in rows.inputFiles())


@pytest.mark.parametrize("fit", [
    lambda df: boosting.adaboost(df, "label", ["a", "b", "c"], rounds=3),
    lambda df: boosting.newton_boost(df, "label", ["a", "b", "c"], ["id"], trees=2, depth=3),
    lambda df: boosting.newton_boost(df, "label", ["a", "b", "c"], ["id"], trees=2, growth="leaf", leaves=6, min_rows=5)])
def test_trees_of_one_block_are_those_of_many(data, monkeypatch, fit):
    """One block is boosted in one task, several by a job per level."""
    df, *_ = data
    levels, plain = [], boosting._level
    monkeypatch.setattr(boosting, "_level", lambda *a: levels.append(1) or plain(*a))
    here = fit(df)
    assert not levels
    monkeypatch.setattr(boosting, "ROW_BLOCK", 150)
    spread = fit(df)
    assert levels

    def nodes(model):
        return [(n.id, n.feature, n.bin, n.left is None) for _, t in model.trees for n in t.all()]
    assert nodes(here) == nodes(spread)
    assert np.allclose([[w, n.value, n.gain] for w, t in here.trees for n in t.all()], [[w, n.value, n.gain] for w, t in spread.trees for n in t.all()])
