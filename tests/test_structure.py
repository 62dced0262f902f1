"""Neighbours, clusters and layouts against brute force, with copies and hot spots."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulith.operators import clustering, joins, manifold, metrics


def frame(spark, points):
    d = len(points[0])
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)],
                                 "id long, " + ", ".join(f"f{i} double" for i in range(d))), [f"f{i}" for i in range(d)]


def clumps(d, seed=5):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(60, d)) * 0.15, rng.normal(size=(60, d)) * 0.15 + 2, rng.uniform(-2, 4, size=(40, d))]
    return np.round(np.vstack([*parts, np.tile(parts[0][:1], (70, 1))]), 3)  # the last 70 are copies


def brute_dbscan(x, eps, k):
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= eps
    core = gap.sum(1) >= k
    label, number = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack, label[i] = [i], number
            while stack:
                j = stack.pop()
                for m in np.nonzero(gap[j])[0]:
                    if core[m] and label[m] < 0:
                        label[m] = number
                        stack.append(m)
            number += 1
    kind = np.where(core, "core", "noise").astype(object)
    for i in np.nonzero(~core)[0]:
        near = [label[m] for m in np.nonzero(gap[i] & core)[0]]
        if near:
            label[i], kind[i] = min(near), "border"
    return gap.sum(1), label, kind


@pytest.mark.parametrize("d,eps,direct", [(2, 0.3, None), (2, 0.3, 0), (5, 0.6, None)])
def test_dbscan(spark, d, eps, direct, monkeypatch):
    if direct is not None:
        monkeypatch.setattr(clustering, "DIRECT_PAIRS", direct)  # force the box refinement
    x = clumps(d)
    df, names = frame(spark, x)
    counts, label, kind = brute_dbscan(x, eps, 6)
    got = {r.id: (r.cluster, r.kind) for r in clustering.dbscan(df, "id", names, eps, 6).collect()}
    assert got == {i: (label[i], kind[i]) for i in range(len(x))}
    exact = {r.id: (r.neighbors, r.core) for r in clustering.core_points(df, "id", names, eps, 6).collect()}
    assert exact == {i: (counts[i], counts[i] >= 6) for i in range(len(x))}


def test_rows_without_a_position_are_noise(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.1, 0.0), (3, None, 0.0), (4, None, 0.0)], "id long, f0 double, f1 double")
    got = {r.id: (r.cluster, r.kind) for r in clustering.dbscan(df, "id", ["f0", "f1"], 0.5, 2).collect()}
    assert got == {1: (0, "core"), 2: (0, "core"), 3: (-1, "noise"), 4: (-1, "noise")}


@pytest.mark.parametrize("few,direct", [(100_000, 20_000_000), (0, 0)])
def test_rows_that_share_an_id_are_told_apart_by_position(spark, few, direct, monkeypatch):
    monkeypatch.setattr(clustering, "LISTED_CELLS", few)
    monkeypatch.setattr(clustering, "DIRECT_PAIRS", direct)
    x = clumps(2)
    _, label, kind = brute_dbscan(x, 0.3, 6)
    df = spark.createDataFrame([(7, *map(float, p)) for p in x], "id long, f0 double, f1 double")
    got = Counter((r.f0, r.f1, r.kind) for r in clustering.dbscan(df, "id", ["f0", "f1"], 0.3, 6).collect())
    assert got == Counter((a, b, k) for (a, b), k in zip(x.tolist(), kind))


def test_dense_rows_are_not_shuffled(spark):
    """Rows of cells that are full of core points stay in their task: a shuffle carries cells."""
    rng = np.random.default_rng(3)
    df, names = frame(spark, np.round(rng.uniform(0, 2, size=(20_000, 2)), 4))
    plan = clustering.dbscan(df.repartition(4), "id", names, 0.5, 10)
    found = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in found and found.count("Exchange") <= 2  # the repartition, and the short table of cells
    assert {(r.cluster, r.kind, r["count"]) for r in plan.groupBy("cluster", "kind").count().collect()} == {(0, "core", 20_000)}


def test_radius_join(spark):
    x = clumps(4)[:120]
    df, names = frame(spark, x)
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if gap[i, j] <= 0.5}
    assert {(r.src, r.dst) for r in joins.radius_join(df, "id", names, 0.5).collect()} == want


def test_radius_join_is_never_broadcast(spark, tmp_path):
    # equal rows compress to almost nothing, so Spark takes the table for a small one
    path = str(tmp_path / "rows")
    spark.range(20_000).selectExpr("id", "cast(id % 7000 as double) AS x").write.parquet(path)
    found = joins.radius_join(spark.read.parquet(path), "id", ["x"], 0.5)
    assert found.count() == 6000 * 3 + 1000 * 1
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pivots,block", [(None, 2048), (6, 16)])
def test_nearest_neighbours_with_copies(spark, pivots, block):
    x = clumps(3)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, v array<double>")
    got = {}
    for r in joins.knn_join(df, "id", "v", 4, pivots=pivots, block_rows=block).collect():
        got.setdefault(r.src, {})[r["rank"]] = r.dst
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(len(x)):
        order = sorted((gap[i, j], j) for j in range(len(x)) if j != i)[:4]
        assert [got[i][k] for k in (1, 2, 3, 4)] == [j for _, j in order]


@pytest.mark.parametrize("ids", ["long", "string"])
def test_nearest_neighbours_of_few_rows_in_tiny_blocks(spark, ids):
    x = [0.0, 1.0, 3.0, 7.0, 8.5, 20.0]
    df = spark.createDataFrame([(i, [v]) for i, v in enumerate(x)], "id long, v array<double>").withColumn("id", F.col("id").cast(ids))
    got = {(str(r["src"]), r["rank"]): str(r["dst"]) for r in joins.knn_join(df, "id", "v", 2, pivots=3, block_rows=1).collect()}
    want = {(str(i), j + 1): str(n) for i, v in enumerate(x)
            for j, n in enumerate(sorted((k for k in range(6) if k != i), key=lambda k: (abs(x[k] - v), k))[:2])}
    assert got == want


def test_vectors_are_sent_a_bounded_number_of_times(spark, monkeypatch):
    # no structure: every pivot's cell reaches every vector, which went out once per pivot
    x = np.random.default_rng(4).normal(size=(2000, 16))
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, v array<double>")
    sent, dealt = [], joins._dealt

    def counted(*args):
        out = dealt(*args)
        sent.append(sum(side.count() for side in out))
        return out
    monkeypatch.setattr(joins, "_dealt", counted)
    got = {(r["src"], r["rank"]): r["dst"] for r in joins.knn_join(df, "id", "v", 3, pivots=200).collect()}
    assert sent[0] <= 2 * (joins.QUERY_GROUPS + 1) * 2000
    gap = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(gap, np.inf)
    near = np.argsort(gap, 1)[:, :3]
    assert got == {(i, j + 1): near[i, j] for i in range(2000) for j in range(3)}


def test_steps_of_the_nearest_search_agree_with_brute_force(monkeypatch):
    monkeypatch.setattr(joins, "QUERY_STEP", 7)
    monkeypatch.setattr(joins, "CANDIDATE_STEP", 11)
    x = np.round(np.random.default_rng(6).normal(size=(150, 2)), 1)  # many ties
    gap = np.sqrt(((x[:40, None] - x[None]) ** 2).sum(2))
    for take in (1, 9, 30, 500):
        places, distances = joins._nearest(x[:40], x, take)
        want = np.argsort(gap, 1, kind="stable")[:, :take]
        assert all((p == w).all() for p, w in zip(places, want))
        assert np.allclose(np.array(distances), np.take_along_axis(gap, want, 1))


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (300, 100)]
    ids = sorted({i for e in chain for i in e} | {999})
    nodes = spark.createDataFrame([(i,) for i in ids], "node long")
    got = {r.node: r.component for r in clustering.connected_components(nodes, spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {i: 0 if i <= 40 else 999 if i == 999 else 100 for i in ids}


@pytest.mark.parametrize("d", [2, 4])
def test_ward_in_rounds_merges_as_the_plain_order(spark, d, monkeypatch):
    monkeypatch.setattr(clustering, "WARD_PAIRS", 20_000)
    monkeypatch.setattr(clustering, "WARD_STEP", (30, 70))
    rng = np.random.default_rng(3)
    x, sizes = rng.normal(size=(400, d)), rng.integers(1, 5, 400)
    want, got = clustering._ward_merges(sizes, x), clustering._ward_rounds(spark, sizes, x)
    assert [(s[0], s[1], s[2], s[4]) for s in got] == [(s[0], s[1], s[2], s[4]) for s in want]
    assert np.allclose([s[3] for s in got], [s[3] for s in want], rtol=1e-9)


def test_ward_in_rounds_with_equal_costs(spark):
    x = np.array([(float(i), float(j)) for i in range(12) for j in range(12)])
    steps = clustering._ward_rounds(spark, np.ones(144), x)
    heights = [s[3] for s in steps]
    assert len(steps) == 143 and heights == sorted(heights)
    assert sum(h * h for h in heights) / 2 == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert all(max(s[1], s[2]) < 143 + s[0] for s in steps)  # a cluster is merged after it was made


def test_ward_query_counts_merges_of_equal_rows(spark, tmp_path):
    from tabulith.catalog import certificates
    spark.createDataFrame([(i, float(i % 3) * 1000, i % 2) for i in range(12)], "s_suppkey long, s_acctbal double, s_nationkey int").write.parquet(
        str(tmp_path / "supplier.parquet"))
    row = certificates.ward_exact(spark, str(tmp_path)).first()
    assert (row["steps"], row["rising"], row["total"]) == (11, True, pytest.approx(8 + 3))


def test_ward(spark):
    x = np.round(np.random.default_rng(2).normal(size=(25, 2)), 3)
    df, names = frame(spark, x)
    labels, steps = clustering.hierarchical(df, names, k=3, mode="exact")
    groups = [[i] for i in range(25)]
    heights = []
    while len(groups) > 1:
        def cost(a, b):
            ga, gb = x[a], x[b]
            return len(a) * len(b) / (len(a) + len(b)) * ((ga.mean(0) - gb.mean(0)) ** 2).sum()
        i, j = min(((i, j) for i in range(len(groups)) for j in range(i)), key=lambda p: cost(groups[p[0]], groups[p[1]]))
        heights.append(math.sqrt(2 * cost(groups[i], groups[j])))
        groups = [g for m, g in enumerate(groups) if m not in (i, j)] + [groups[i] + groups[j]]
        if len(groups) == 3:
            want = {frozenset(g) for g in groups}
    assert np.allclose([r.height for r in steps.orderBy("step").collect()], heights)
    got = {}
    for r in labels.collect():
        got.setdefault(r.cluster, set()).add(r.id)
    assert {frozenset(g) for g in got.values()} == want


def test_kmeans_inertia_is_that_of_its_centers(spark):
    x = clumps(2)
    df, names = frame(spark, x)
    _, centers, inertia = clustering.kmeans_pp(df, names, 3, n_init=2)
    step = clustering.lloyd_step(df, names, centers).collect()
    assert sum(r.inertia for r in step) == pytest.approx(inertia, rel=1e-6)


def test_kmeans_starts_together_equal_single_steps(spark):
    """The start returned is a fixed point of plain Lloyd steps, and no row order matters."""
    x = clumps(2)
    df, names = frame(spark, x)
    for fit in (clustering.kmeans, clustering.kmeans_pp):
        labels, centers, inertia = fit(df, names, 3, n_init=4, tol=0.0)
        c, rows = np.array(centers), np.array([[r[n] for n in names] + [r.cluster] for r in labels.collect()])
        far = ((rows[:, None, :-1] - c[None]) ** 2).sum(2)
        assert (far.argmin(1) == rows[:, -1]).all() and far.min(1).sum() == pytest.approx(inertia)
        for g in range(3):
            assert np.allclose(rows[rows[:, -1] == g, :-1].mean(0), c[g])
        again = fit(df.repartition(3), names, 3, n_init=4, tol=0.0)
        assert np.allclose(again[1], centers)


def test_kmeans_on_missing_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 5.0, 5.0), (4, None, 1.0)], "id int, f0 double, f1 double")
    labels, centers, inertia = clustering.kmeans(df, ["f0", "f1"], 3, n_init=2)
    got = {r.id: r.cluster for r in labels.collect()}
    assert got[4] is None and got[1] == got[2] != got[3] and inertia == 0.0 and len(centers) == 3
    empty, centers, inertia = clustering.kmeans_pp(df.where("id > 9"), ["f0", "f1"], 3)
    assert empty.count() == 0 and centers == [] and inertia == 0.0


def test_silhouette(spark):
    x = clumps(2)
    df, names = frame(spark, x)
    labelled = df.withColumn("c", F.when(F.col("f0") > 1, 1).when(F.col("f1") > 2.5, -1).otherwise(0))
    c = np.array([r.c for r in labelled.orderBy("id").collect()])
    keep = c >= 0
    gap = np.sqrt(((x[keep][:, None] - x[keep][None]) ** 2).sum(2))
    own = c[keep]
    a = np.array([gap[i, own == own[i]].sum() / ((own == own[i]).sum() - 1) for i in range(len(own))])
    b = np.array([gap[i, own != own[i]].mean() for i in range(len(own))])
    got = metrics.silhouette(labelled, names, "c", block_rows=32).first()[0]
    assert got == pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-6)


def test_layouts_keep_neighbours(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(25, 6)), rng.normal(size=(25, 6)) + 8])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, v array<double>")
    graph = manifold.tsne_affinities(df, "id", "v", 5.0)
    assert graph.agg(F.sum("weight")).first()[0] == pytest.approx(0.5, abs=1e-6)
    weights = [r.weight for r in manifold.fuzzy_graph(df, "id", "v", 5).collect()]
    assert 0 < min(weights) and max(weights) <= 1
    y = np.array([[r.dim1, r.dim2] for r in manifold.umap_layout(df, "id", "v", neighbors=5, epochs=4).orderBy("id").collect()])
    gap = np.sqrt(((y[:, None] - y[None]) ** 2).sum(2))
    np.fill_diagonal(gap, np.inf)
    assert np.mean((gap.argmin(1) < 25) == (np.arange(50) < 25)) > 0.9


@pytest.mark.parametrize("k", [3, 40])
def test_a_round_of_kmeans_over_stored_blocks_equals_plain_sums(spark, monkeypatch, k):
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 70)
    x = np.random.default_rng(3).normal(size=(500, 2))
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "code long, x0 double, x1 double").repartition(3)
    centers = np.random.default_rng(4).normal(size=(2, k, 2))
    found = {r["slot"]: r for r in clustering._assigned(clustering._blocks(rows), centers, costs=True)}
    for start in range(2):
        square = ((x[:, None] - centers[start][None]) ** 2).sum(2)
        for c in range(k):
            mine = square.argmin(1) == c
            r = found.get(start * k + c)
            assert (r["n"] if r else 0) == mine.sum()
            if r:
                assert np.allclose(r["total"], x[mine].sum(0)) and r["cost"] == pytest.approx(square[mine, c].sum())


def test_condensed_ward_gives_rows_with_gaps_no_cluster(spark):
    rows = [(i, float(i % 5), float(i % 3)) for i in range(60)] + [(60, None, 1.0), (61, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    labels, steps = clustering.hierarchical(df, ["a", "b"], k=3, micro=15)
    found = {r["id"]: r["cluster"] for r in labels.collect()}
    assert found[60] is None and found[61] is None and {found[i] for i in range(60)} == {0, 1, 2}
    assert steps.count() == 14
    for i in range(60):
        assert found[i] == found[i % 15]


def test_numbers_of_four_bytes_travel_in_four(spark, monkeypatch):
    x = np.random.default_rng(9).normal(size=(60, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, v array<float>")
    sizes, dealt = set(), joins._dealt

    def counted(*args):
        out = dealt(*args)
        sizes.update(r["n"] for side in out for r in side.select(F.length("v").alias("n")).collect())
        return out
    monkeypatch.setattr(joins, "_dealt", counted)
    got = {(r["src"], r["rank"]): r["distance"] for r in joins.knn_join(df, "id", "v", 2).collect()}
    assert sizes == {32}
    gap = np.sqrt(((x[:, None].astype(float) - x[None]) ** 2).sum(2))
    np.fill_diagonal(gap, np.inf)
    assert all(got[i, j + 1] == pytest.approx(np.sort(gap[i])[j], abs=1e-12) for i in range(60) for j in range(2))
