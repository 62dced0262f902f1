"""Neighbour graphs and two- or three-dimensional layouts of them.

The graphs are exact unless asked otherwise. In the layouts attraction runs over every edge and repulsion over all rows,
far ones gathered by space cells. Up to ``HELD_ROWS`` rows a round is one job: the driver holds the positions, the edges
stay with the executors in blocks. Beyond, the positions are a stored table as well.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import cut_lineage, replace_state, reused, small_frame, write_out
from .joins import knn_join
from .neighbor_forest import approximate_knn
from .repulsion import HELD_ROWS, LEAF_ROWS, Force, Held, fuzzy_force, student_force, summed_forces

NEAREST_SCALE = 1e-3  # smallest width of a kernel relative to the mean neighbour distance
EDGE_BYTES = 12  # of an edge in one direction: a row number and a weight
BLOCK_BYTES, TASK_BYTES = 16 << 20, 64 << 20  # edges of a block, and of the blocks that a task reads
TASK_PAIRS = 1 << 20  # pairs of rows that are worth a task


def _neighbor_lists(knn: DataFrame) -> DataFrame:
    """One row per source with its distances in rank order (at most k entries)."""
    lists = knn.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("rank", "dst", "distance"))).alias("near"))
    return lists.withColumn("far", F.transform("near", lambda e: e["distance"]))


def _matrix(lists: pd.Series) -> np.ndarray:
    """Ragged lists as rows, padded with infinity."""
    width = max((len(v) for v in lists), default=0)
    out = np.full((len(lists), width), np.inf)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def _fuzzy_kernel(neighbors: int) -> Column:
    target = math.log2(neighbors)

    @F.pandas_udf("struct<rho double, sigma double>")
    def solve(far: pd.Series) -> pd.DataFrame:
        d = _matrix(far)
        known = np.isfinite(d)
        positive = np.where(known & (d > 0), d, np.inf)
        rho = positive.min(1)
        rho[~np.isfinite(rho)] = 0.0
        beyond = np.where(known, np.maximum(d - rho[:, None], 0.0), np.inf)
        low, high, sigma = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
        for _ in range(64):
            total = np.exp(-beyond / sigma[:, None]).sum(1)
            above = total > target
            high = np.where(above, sigma, high)
            low = np.where(above, low, sigma)
            sigma = np.where(np.isinf(high), sigma * 2, (low + high) / 2)
        mean = np.where(known, d, 0.0).sum(1) / np.maximum(known.sum(1), 1)
        return pd.DataFrame({"rho": rho, "sigma": np.maximum(sigma, NEAREST_SCALE * mean)})

    return solve(F.col("far"))


def knn_graph(points: DataFrame, key: str, vector: str, k: int = 15, mode: str = "exact") -> DataFrame:
    """k nearest other rows, ``exact`` or ``approximate`` (a forest of projections with measured recall)."""
    if mode not in ("exact", "approximate"):
        raise ValueError(f"unknown mode {mode}")
    return knn_join(points, key, vector, k) if mode == "exact" else approximate_knn(points, key, vector, k)[0]


def fuzzy_graph(points: DataFrame, key: str, vector: str, neighbors: int = 15, mode: str = "exact") -> DataFrame:
    """Undirected weighted graph (src < dst, weight). ``neighbors`` counts the row itself.

    Each row's kernel starts at its nearest distinct neighbour and is as wide as makes its
    weights sum to log2(neighbors); the two directions a, b of a pair become a + b - ab.
    """
    kernels = _neighbor_lists(knn_graph(points, key, vector, neighbors - 1, mode)).withColumn("k", _fuzzy_kernel(neighbors))
    edges = kernels.select("src", "k", F.explode("near").alias("e"))
    beyond = F.greatest(F.col("e.distance") - F.col("k.rho"), F.lit(0.0))
    weight = F.when(beyond > 0, F.exp(-beyond / F.col("k.sigma"))).otherwise(1.0)
    directed = edges.select(F.least("src", "e.dst").alias("a"), F.greatest("src", "e.dst").alias("b"), weight.alias("w"))
    both = F.sum("w") - F.when(F.count("*") == 2, F.max("w") * F.min("w")).otherwise(0.0)
    return directed.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(both.alias("weight"))


def strong_edges(graph: DataFrame, nodes: int = 400, weight: float = 0.2) -> DataFrame:
    """Edges for display: both ends among the first ``nodes`` ids of the graph, weight at least ``weight``."""
    ids = graph.select(F.explode(F.array("src", "dst")).alias("id")).distinct().orderBy("id").limit(nodes)
    first = F.broadcast(ids)  # at most `nodes` rows
    return (graph.where(F.col("weight") >= weight).join(first.withColumnRenamed("id", "src"), "src", "left_semi")
            .join(first.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst", "weight"))


def perplexity_for(rows: int) -> float:
    return min(30.0, max(5.0, (rows - 1) / 3.0))


def _entropy_kernel(perplexity: float) -> Column:
    target = math.log(perplexity)

    @F.pandas_udf("array<double>")
    def solve(far: pd.Series) -> pd.Series:
        d = _matrix(far)
        known = np.isfinite(d)
        square = np.where(known, d * d, np.inf)
        square = square - square.min(1, keepdims=True)
        low, high, beta = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
        share = np.zeros_like(d)
        for _ in range(100):
            e = np.exp(-square * beta[:, None])
            share = e / e.sum(1, keepdims=True)
            entropy = -(share * np.log(np.maximum(share, 1e-300))).sum(1)
            wide = entropy > target
            low = np.where(wide, beta, low)
            high = np.where(wide, high, beta)
            beta = np.where(np.isinf(high), beta * 2, (low + high) / 2)
        return pd.Series([row[k].tolist() for row, k in zip(share, known)])

    return solve(F.col("far"))


def tsne_affinities(points: DataFrame, key: str, vector: str, perplexity: float | None = None,
                    mode: str = "exact") -> DataFrame:
    """Symmetric joint probabilities (src < dst, weight); twice their sum is 1. Counts the rows."""
    n = points.count()
    perplexity = perplexity or perplexity_for(n)
    k = min(n - 1, int(3 * perplexity + 1))
    lists = _neighbor_lists(knn_graph(points, key, vector, k, mode)).withColumn("p", _entropy_kernel(perplexity))
    edges = lists.select("src", F.explode(F.arrays_zip("near", "p")).alias("e"))
    directed = edges.select(F.least("src", "e.near.dst").alias("a"), F.greatest("src", "e.near.dst").alias("b"),
                            F.col("e.p").alias("p"))
    return directed.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg((F.sum("p") / (2.0 * n)).alias("weight"))


# ---- layouts ----------------------------------------------------------------

def start_positions(points: DataFrame, key: str, vector: str, dims: int, spread: float) -> DataFrame:
    """The first principal components, scaled to a standard deviation of ``spread`` on the first axis."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rows = points.select(as_column(key).alias("id"), array_to_vector(F.transform(as_column(vector), lambda v: v.cast("double"))).alias("_v"))
    model = PCA(k=dims, inputCol="_v", outputCol="_p").fit(rows)
    moved = model.transform(rows).select("id", vector_to_array("_p").alias("y"))
    row = moved.agg(*[F.avg(F.col("y")[i]).alias(f"m{i}") for i in range(dims)], F.stddev_pop(F.col("y")[0]).alias("s")).first()
    scale = spread / (row["s"] or 1.0)
    return moved.select("id", F.array(*[(F.col("y")[i] - F.lit(row[f"m{i}"])) * F.lit(scale) for i in range(dims)]).alias("y"))


def _pull(edges: DataFrame, positions: DataFrame, dims: int, factor) -> DataFrame:
    """Summed attraction per row over all its edges: (id, pull)."""
    a = positions.select(F.col("id").alias("src"), F.col("y").alias("ya"))
    b = positions.select(F.col("id").alias("dst"), F.col("y").alias("yb"))
    met = edges.join(a, "src").join(b, "dst")
    gap = F.zip_with("ya", "yb", lambda p, q: p - q)
    met = met.withColumn("gap", gap).withColumn("sq", F.aggregate("gap", F.lit(0.0), lambda s, v: s + v * v))
    force = F.transform("gap", lambda v: v * factor(F.col("weight"), F.col("sq")))
    both = F.inline(F.array(F.struct(F.col("src").alias("id"), force.alias("f")),
                            F.struct(F.col("dst").alias("id"), F.transform(force, lambda v: -v).alias("f"))))
    return met.select(both).groupBy("id").agg(F.array(*[F.sum(F.col("f")[i]) for i in range(dims)]).alias("pull"))


@dataclass
class _Layout:
    """A layout whose positions the driver holds: ``rows`` (id, row) and ``blocks`` of edges are stored, ``y`` is in the order of row."""

    rows: DataFrame
    blocks: DataFrame
    y: np.ndarray
    owner: np.ndarray | None  # the first row of each row's id, where ids repeat

    def round(self, force: Force, pull: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Repulsion, its kernel sums, and attraction of every row; rows of one id share the attraction of all of them."""
        n, dims = self.y.shape
        sent = self.blocks.sparkSession.sparkContext.broadcast(self.y)
        f, z, drawn = np.zeros((n, dims)), np.zeros(n), np.zeros((n, dims))
        for r in summed_forces(self.blocks, dims, force, Held(sent, pull)).collect():  # one row per block
            at = np.frombuffer(r["rows"], np.int64)
            f[at], z[at] = np.frombuffer(r["f"]).reshape(-1, dims), np.frombuffer(r["z"])
            own = np.frombuffer(r["pull"]).reshape(-1, dims)
            drawn[r["first"]:r["first"] + len(own)] = own
        sent.destroy()
        if self.owner is not None:
            drawn = np.stack([np.bincount(self.owner, drawn[:, i], n)[self.owner] for i in range(dims)], 1)
        return f, z, drawn

    def placed(self) -> DataFrame:
        """(id, y) of every row, stored."""
        sent = self.rows.sparkSession.sparkContext.broadcast(self.y)

        @F.pandas_udf("array<double>")
        def place(row: pd.Series) -> pd.Series:
            return pd.Series(list(sent.value[row.to_numpy()]))

        out = write_out(self.rows.select("id", place("row").alias("y")), "layout")
        sent.destroy()
        return out


def _numbered(start: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(id, row) with rows numbered from 0, stored, and their positions in that order."""
    stored = write_out(start.withColumn("_m", F.monotonically_increasing_id()), "start")
    found = stored.select("_m", "y").toArrow().sort_by("_m")
    parts, counts = np.unique(found.column("_m").to_numpy() >> 33, return_counts=True)
    first = np.zeros(int(parts.max()) + 1, np.int64)
    first[parts] = counts.cumsum() - counts
    row = F.get(F.array(*[F.lit(int(v)) for v in first]), F.shiftright("_m", 33).cast("int")) + F.col("_m").bitwiseAND((1 << 33) - 1)
    return stored.select("id", row.cast("long").alias("row")), np.array(found.column("y").to_pylist(), dtype=float)


def edge_blocks(graph: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """Edges of the graph by runs of rows: (block, total, first, last, ends, other, weight). An edge stands with both of its ends.

    The ``ends`` say where each row's edges end among the block's; ``other`` has the row numbers of their far ends.
    """
    spark = graph.sparkSession
    met = (graph.join(rows.select(F.col("id").alias("src"), F.col("row").alias("a")), "src")
           .join(rows.select(F.col("id").alias("dst"), F.col("row").alias("b")), "dst"))
    both = met.select(F.inline(F.array(F.struct(F.col("a").alias("row"), F.col("b").alias("other"), "weight"),
                                       F.struct(F.col("b").alias("row"), F.col("a").alias("other"), "weight"))))
    # few rows are not worth many tasks a round
    edges, tasks = 2 * graph.count(), min(spark.sparkContext.defaultParallelism, -(-n * min(n, LEAF_ROWS) // TASK_PAIRS))
    size = -(-n // max(tasks, -(-edges * EDGE_BYTES // BLOCK_BYTES)))
    total = -(-n // size)

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        row, other, weight = (pdf[c].to_numpy() for c in ("row", "other", "weight"))
        order = np.lexsort((weight, other, row))
        ends = np.searchsorted(row[order], np.arange(block * size, min(n, (block + 1) * size)), side="right")
        return pd.DataFrame({"block": [block], "ends": [ends.astype(np.int64).tobytes()], "other": [other[order].astype(np.int32).tobytes()],
                             "weight": [weight[order].astype(float).tobytes()]})

    found = (both.withColumn("block", F.floor(F.col("row") / size)).groupBy("block")
             .applyInPandas(packed, "block long, ends binary, other binary, weight binary"))
    every = spark.range(total).select(F.col("id").alias("block"), F.lit(total).alias("total"), (F.col("id") * size).alias("first"),
                                      F.least(F.lit(n), (F.col("id") + 1) * size).alias("last"))
    blocks = write_out(every.join(found, "block", "left"), "edges")
    return blocks.repartitionByRange(max(min(tasks, total), -(-edges * EDGE_BYTES // TASK_BYTES)), "block")


@contextmanager
def _held_layout(graph: DataFrame, start: DataFrame) -> Iterator[_Layout]:
    rows, y = _numbered(start)
    twice = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.sort_array(F.collect_list("row")).alias("r")).where(F.size("r") > 1).collect()
    owner = np.arange(len(y))
    for r in twice:
        owner[r["r"]] = r["r"][0]
    with reused(edge_blocks(graph, rows, len(y))) as blocks:
        yield _Layout(rows, blocks, y, owner if twice else None)


def _dimensions(placed: DataFrame, dims: int) -> DataFrame:
    return placed.select("id", *[F.col("y")[i].alias(f"dim{i + 1}") for i in range(dims)])


def layout_curve(min_dist: float = 0.1, spread: float = 1.0) -> tuple[float, float]:
    """(a, b) of 1 / (1 + a d^(2b)) nearest to 1 up to ``min_dist`` and exp(-(d - min_dist) / spread) beyond, by least squares."""
    d = np.linspace(0.0, 3.0 * spread, 300)[1:]
    wanted = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    log_d, at, damp = np.log(d), np.zeros(2), 1e-3  # logarithms of a and b

    def miss(point):
        return 1.0 / (1.0 + np.exp(point[0] + 2.0 * np.exp(point[1]) * log_d)) - wanted

    now = miss(at)
    for _ in range(200):  # damped Gauss-Newton steps
        curve = now + wanted
        slope = -curve * (1.0 - curve)
        jacobian = np.stack([slope, slope * 2.0 * np.exp(at[1]) * log_d], 1)
        normal = jacobian.T @ jacobian
        step = np.linalg.solve(normal + damp * np.diag(np.diag(normal)), jacobian.T @ now)
        trial = miss(at - step)
        if (trial**2).sum() <= (now**2).sum():
            at, now, damp = at - step, trial, damp / 10
            if np.abs(step).max() < 1e-12:
                break
        else:
            damp *= 10
    return float(np.exp(at[0])), float(np.exp(at[1]))


def umap_layout(points: DataFrame, key: str, vector: str, dims: int = 2, neighbors: int = 15, epochs: int = 50,
                rate: float = 1.0, negatives: int = 5, min_dist: float = 0.1, spread: float = 1.0) -> DataFrame:
    """Layout of the fuzzy graph in one to three dimensions: (id, dim1..).

    An epoch joins the edges to their ends and sums the repulsion of all rows; ``min_dist`` and
    ``spread`` shape the curve of both forces. Each row is pushed ``negatives`` times its degree
    by the mean of the others.
    """
    graph = cut_lineage(fuzzy_graph(points, key, vector, neighbors))
    start = start_positions(points, key, vector, dims, 5.0)
    degree = graph.select(F.inline(F.array(F.struct(F.col("src").alias("id"), "weight"), F.struct(F.col("dst").alias("id"), "weight"))))
    degree = cut_lineage(degree.groupBy("id").agg(F.sum("weight").alias("degree")))
    a, b = layout_curve(min_dist, spread)
    n = float(points.count())

    if n <= HELD_ROWS:
        def pull(w, sq):
            safe = np.maximum(sq, 1e-12)
            near = safe**(b - 1.0)
            return np.where(sq > 0, w * (-2.0 * a * b * near) / (1.0 + a * (near * safe)), 0.0)

        with _held_layout(graph, start) as layout:
            share = np.zeros(len(layout.y))
            for r in layout.rows.join(degree, "id").select("row", "degree").collect():
                share[r["row"]] = r["degree"]
            for epoch in range(epochs):
                f, _, drawn = layout.round(fuzzy_force(a, b), pull)
                apart = f / n * share[:, None] * negatives
                layout.y = layout.y + rate * (1.0 - epoch / epochs) * np.clip(drawn + apart, -4.0, 4.0)
        return _dimensions(layout.placed(), dims)

    def attraction(w, sq):
        safe = F.greatest(sq, F.lit(1e-12))
        return F.when(sq > 0, w * (-2.0 * a * b * F.pow(safe, b - 1.0)) / (1.0 + a * F.pow(safe, b))).otherwise(0.0)

    positions, path = replace_state(start, "layout", None)
    for epoch in range(epochs):
        pushed = summed_forces(positions, dims, fuzzy_force(a, b))
        pulled = pushed.join(_pull(graph, positions, dims, attraction), "id", "left").join(degree, "id", "left")
        step = rate * (1.0 - epoch / epochs)

        def moved(i):
            drawn = F.coalesce(F.col("pull")[i], F.lit(0.0))
            apart = F.col("f")[i] / n * F.coalesce("degree", F.lit(0.0)) * negatives
            return F.col("y")[i] + step * F.greatest(F.lit(-4.0), F.least(F.lit(4.0), drawn + apart))

        placed = pulled.select("id", F.array(*[moved(i) for i in range(dims)]).alias("y"))
        positions, path = replace_state(placed, "layout", path)
    return _dimensions(positions, dims)


def tsne_layout(points: DataFrame, key: str, vector: str, dims: int = 2, perplexity: float | None = None,
                iterations: int = 1000, rate: float | None = None, exaggeration: float = 12.0,
                exaggerated: int = 250) -> DataFrame:
    """t-SNE layout in one to three dimensions: (id, dim1..), by gradient steps with momentum over all rows."""
    n = points.count()
    graph = cut_lineage(tsne_affinities(points, key, vector, perplexity))
    start = start_positions(points, key, vector, dims, 1e-4)
    rate = rate or max(n / exaggeration / 4.0, 50.0)

    def phase(step):
        return (exaggeration, 0.5) if step < exaggerated else (1.0, 0.8)

    if n <= HELD_ROWS:
        with _held_layout(graph, start.where(F.col("id").isNotNull())) as layout:  # a row without an id has no place
            v = np.zeros_like(layout.y)
            for step in range(iterations):
                boost, momentum = phase(step)
                f, z, drawn = layout.round(student_force, lambda p, sq, boost=boost: boost * p / (1.0 + sq))
                v = momentum * v - rate * 4.0 * (drawn - f / max(z.sum(), 1e-12))
                layout.y = layout.y + v
        return _dimensions(layout.placed(), dims)
    state, path = replace_state(start.withColumn("v", F.array(*[F.lit(0.0)] * dims)), "layout", None)
    for step in range(iterations):
        boost, momentum = phase(step)
        pushed = summed_forces(state.select("id", "y"), dims, student_force)
        pulled = _pull(graph, state.select("id", "y"), dims, lambda p, sq: boost * p / (1.0 + sq))
        z = max(pushed.agg(F.sum("z").alias("z")).first()["z"] or 0.0, 1e-12)
        forces = pushed.join(state.select("id", "v"), "id").join(pulled, "id", "left")

        def velocity(i):
            gradient = 4.0 * (F.coalesce(F.col("pull")[i], F.lit(0.0)) - F.col("f")[i] / F.lit(z))
            return momentum * F.col("v")[i] - rate * gradient

        moved = (forces.withColumn("w", F.array(*[velocity(i) for i in range(dims)]))
                 .select("id", F.zip_with("y", "w", lambda p, q: p + q).alias("y"), F.col("w").alias("v")))
        state, path = replace_state(moved, "layout", path)
    return _dimensions(state, dims)


def manifold_summary(spark, runs: Sequence[tuple[str, int, int, str]]) -> DataFrame:
    """(method, rows, dimensions, status): what was run, and the error text of what failed."""
    return small_frame(spark, list(runs), "method string, rows long, dimensions int, status string")
