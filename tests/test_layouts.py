"""Repulsion by space cells and the layouts that use it, against sums over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulith.operators import manifold, repulsion


def all_pairs(y, force):
    gap = y[:, None, :] - y[None, :, :]
    n, d = y.shape
    f, z = force(gap.reshape(-1, d), (gap**2).sum(2).ravel())
    apart = ~np.eye(n, dtype=bool)
    return (f.reshape(n, n, d) * apart[:, :, None]).sum(1), (z.reshape(n, n) * apart).sum(1)


def positions(spark, y):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(y)], "id long, y array<double>")


def cloud(dims, seed):
    """A third of the rows in one tiny spot, groups of copies, two far rows."""
    rng = np.random.default_rng(seed)
    spot = 0.25 + 1e-5 * rng.normal(size=(200, dims))
    copies = np.repeat(rng.normal(size=(4, dims)), 15, axis=0)
    return np.concatenate([rng.normal(size=(340, dims)), spot, copies, [[40.0] * dims, [-30.0] * dims]])


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_student_repulsion_is_near_the_sum_over_all_pairs(spark, monkeypatch, dims):
    monkeypatch.setattr(repulsion, "DIRECT_PAIRS", 0)
    monkeypatch.setattr(repulsion, "LEAF_ROWS", 0)
    y = cloud(dims, dims)
    got = repulsion.summed_forces(positions(spark, y), dims, repulsion.student_force).orderBy("id").collect()
    f, z = all_pairs(y, repulsion.student_force)
    assert [r.id for r in got] == list(range(len(y)))
    assert np.abs(np.array([r.z for r in got]) / z - 1).max() < 0.02
    miss = np.linalg.norm(np.array([r.f for r in got]) - f, axis=1)
    assert miss.max() < 0.05 * np.linalg.norm(f, axis=1).max()
    assert np.sqrt((miss**2).mean()) < 0.01 * np.sqrt((f**2).sum(1).mean())


def test_fuzzy_repulsion_is_near_the_sum_over_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(repulsion, "LEAF_ROWS", 100)
    rng = np.random.default_rng(7)
    y = rng.normal(size=(500, 2)) * 5
    force = repulsion.fuzzy_force(1.577, 0.895)
    got = np.array([r.f for r in repulsion.summed_forces(positions(spark, y), 2, force).orderBy("id").collect()])
    f, _ = all_pairs(y, force)
    assert np.linalg.norm(got - f) < 0.02 * np.linalg.norm(f)


def test_rows_meet_every_other_row_exactly_once(spark, monkeypatch):
    """With a kernel of 1, z counts the other rows, in few and many blocks."""
    def ones(gap, square):
        return np.zeros_like(gap), np.ones(len(gap))

    y = cloud(2, 5)
    for block, direct, leaf in ((8192, 1 << 17, 4096), (16, 0, 50), (16, 1 << 17, 0)):
        monkeypatch.setattr(repulsion, "BLOCK_ROWS", block)
        monkeypatch.setattr(repulsion, "DIRECT_PAIRS", direct)
        monkeypatch.setattr(repulsion, "LEAF_ROWS", leaf)
        got = repulsion.summed_forces(positions(spark, y), 2, ones).collect()
        assert len(got) == len(y)
        assert {round(r.z, 6) for r in got} == {len(y) - 1}


def test_one_place_one_row_and_no_rows(spark):
    same = repulsion.summed_forces(positions(spark, np.ones((50, 2))), 2, repulsion.student_force).collect()
    assert {tuple(r.f) for r in same} == {(0.0, 0.0)} and {r.z for r in same} == {49.0}
    one = repulsion.summed_forces(positions(spark, np.ones((1, 2))), 2, repulsion.student_force).collect()
    assert one[0].z == 0.0
    exact = repulsion.summed_forces(positions(spark, np.array([[0.0, 0.0], [3.0, 4.0]])), 2, repulsion.student_force).orderBy("id").collect()
    assert np.allclose([exact[0].f, exact[1].f], [[-3 / 676, -4 / 676], [3 / 676, 4 / 676]]) and exact[0].z == pytest.approx(1 / 26)
    none = positions(spark, np.ones((1, 2))).where(F.lit(False))
    assert repulsion.summed_forces(none, 2, repulsion.student_force).count() == 0


def test_curve_follows_the_minimum_distance():
    assert manifold.layout_curve(0.1) == pytest.approx((1.5769, 0.8951), abs=2e-3)
    d = np.linspace(0.01, 3, 200)
    for min_dist in (0.0, 0.5):
        a, b = manifold.layout_curve(min_dist)
        wanted = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist)))
        assert np.abs(1 / (1 + a * d ** (2 * b)) - wanted).mean() < 0.04


def groups(spark):
    """Three tight groups of 30 vectors in five dimensions."""
    rng = np.random.default_rng(3)
    centers = np.eye(5)[:3] * 20
    rows = [(i, [float(v) for v in centers[i % 3] + rng.normal(size=5)]) for i in range(90)]
    return spark.createDataFrame(rows, "id long, v array<double>")


def separation(layout, dims):
    """Smallest distance between group centers over the largest mean distance to the own center."""
    rows = layout.orderBy("id").collect()
    y = np.array([[r[f"dim{i + 1}"] for i in range(dims)] for r in rows])
    assert len(y) == 90 and np.isfinite(y).all()
    centers = np.array([y[g::3].mean(0) for g in range(3)])
    inside = max(np.linalg.norm(y[g::3] - centers[g], axis=1).mean() for g in range(3))
    return min(np.linalg.norm(centers[a] - centers[b]) for a, b in ((0, 1), (0, 2), (1, 2))) / inside


@pytest.mark.parametrize("dims", [2, 3])
def test_fuzzy_layout_keeps_groups_apart(spark, dims):
    assert separation(manifold.umap_layout(groups(spark), "id", "v", dims, neighbors=8, epochs=5), dims) > 2


def test_student_layout_takes_the_gradient_steps(spark):
    """Three steps, the first two exaggerated, as worked out on dense matrices."""
    points, n = groups(spark), 90
    p = np.zeros((n, n))
    for r in manifold.tsne_affinities(points, "id", "v", 8.0).collect():
        p[r.src, r.dst] = p[r.dst, r.src] = r.weight
    y = np.array([r.y for r in manifold.start_positions(points, "id", "v", 2, 1e-4).orderBy("id").collect()])
    v = np.zeros_like(y)
    for step in range(3):
        boost, momentum = (12.0, 0.5) if step < 2 else (1.0, 0.8)
        gap = y[:, None, :] - y[None, :, :]
        w = 1 / (1 + (gap**2).sum(2))
        np.fill_diagonal(w, 0)
        v = momentum * v - 50.0 * 4 * (((boost * p - w / w.sum()) * w)[:, :, None] * gap).sum(1)
        y = y + v
    got = manifold.tsne_layout(points, "id", "v", 2, perplexity=8.0, iterations=3, exaggerated=2).orderBy("id").collect()
    assert np.allclose([[r.dim1, r.dim2] for r in got], y, rtol=1e-6, atol=1e-10)


@pytest.mark.parametrize("layout", ["umap", "tsne"])
def test_rounds_do_not_pile_up_size_guesses(spark, monkeypatch, layout):
    """Spark guesses the size of a join as the product of its sides: kept from round to round its digits would multiply."""
    x = np.random.default_rng(8).normal(size=(40, 3))
    points = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, v array<double>")
    digits, forces = [], manifold.summed_forces

    def watched(positions, *rest):
        digits.append(len(positions._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().__str__()))
        return forces(positions, *rest)
    monkeypatch.setattr(manifold, "summed_forces", watched)
    if layout == "umap":
        out = manifold.umap_layout(points, "id", "v", neighbors=5, epochs=4)
    else:
        out = manifold.tsne_layout(points, "id", "v", perplexity=5.0, iterations=4, exaggerated=2)
    assert out.count() == 40
    assert len(digits) == 4 and max(digits) <= 10, digits


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_held_repulsion_is_near_the_sum_over_all_pairs(monkeypatch, dims):
    """The walk through the cells in two shares, down to cells whose rows cannot be told apart."""
    monkeypatch.setattr(repulsion, "NEAR_ROWS", 100)
    y = cloud(dims, dims)
    y[-60:-2] = y[-60]
    cells = repulsion.Cells(y)
    shares = [cells.forces(a, b, repulsion.student_force) for a, b in ((0, 250), (250, len(y)))]
    f, z = all_pairs(y[cells.order], repulsion.student_force)
    assert np.abs(np.concatenate([s[1] for s in shares]) / z - 1).max() < 0.03
    miss = np.linalg.norm(np.concatenate([s[0] for s in shares]) - f, axis=1)
    assert np.sqrt((miss**2).mean()) < 0.01 * np.sqrt((f**2).sum(1).mean())
    monkeypatch.setattr(repulsion, "NEAR_ROWS", 10)
    met = cells.forces(0, len(y), lambda gap, square: (np.zeros_like(gap), np.ones(len(gap))))[1]
    assert set(np.round(met, 6)) == {len(y) - 1}


@pytest.mark.parametrize("layout", ["umap", "tsne"])
def test_held_and_stored_positions_give_one_layout(spark, monkeypatch, layout):
    """Also with more rows than are met pair by pair, with an id that comes twice and with rows without edges."""
    x = np.random.default_rng(4).normal(size=(60, 3))
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(x)] + ([(7, [0.5, 0.5, 0.5])] if layout == "umap" else [])
    points = spark.createDataFrame(rows, "id long, v array<double>")

    def placed(leaf, held):
        monkeypatch.setattr(repulsion, "LEAF_ROWS", leaf)
        monkeypatch.setattr(manifold, "HELD_ROWS", held)
        out = (manifold.umap_layout(points, "id", "v", neighbors=4, epochs=3) if layout == "umap" else
               manifold.tsne_layout(points, "id", "v", perplexity=5.0, iterations=3, exaggerated=2))
        return np.array(sorted([r.id, r.dim1, r.dim2] for r in out.collect()))

    stored = placed(4096, 0)
    assert len(stored) == len(rows)
    for leaf in (4096, 20):
        assert np.allclose(placed(leaf, 1000), stored, rtol=1e-4, atol=1e-7)


def test_a_round_of_a_layout_is_one_job(spark):
    points = groups(spark).cache()

    def jobs(epochs):
        spark.sparkContext.setJobGroup(f"layout-{epochs}", "")
        manifold.umap_layout(points, "id", "v", neighbors=8, epochs=epochs).count()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"layout-{epochs}"))

    assert jobs(6) - jobs(2) < 10  # four rounds; adaptive plans add a job now and then
