"""K-means, DBSCAN and Ward clustering, and their single steps."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_column, euclidean
from ..runtime import cut_lineage, one_row, reused, small_frame, write_out
from .joins import _box_gap, _box_reach, cell_codes, distance_join, near_cells, neighbor_counts

DIRECT_PAIRS = 20_000_000  # up to here point pairs of undecided cells are compared at once
LISTED_CELLS = 100_000     # up to here DBSCAN sends its table of cells to all tasks


WARD_PLAIN = 2048          # up to here Ward clustering keeps the costs of all pairs
WARD_PAIRS = 1 << 26       # cluster pairs that a task compares
WARD_STEP = (128, 4096)    # clusters per numpy step
ROUND_CELLS = 1 << 16      # row and center pairs per numpy step of k-means
BLOCK_ROWS = 4096          # rows that k-means stores together
BATCH_BYTES = 16 << 20     # of stored blocks that a task reads at once
FEW_CENTERS = 16           # up to here centers are compared one after the other
CONDENSE_ROUNDS = 10       # rounds of k-means that condense rows for Ward clustering


# ---- k-means ----------------------------------------------------------------

def _uniform(codes: np.ndarray, start: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit codes, other ones for every start and step (multipliers of a published bit mixer)."""
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64) + np.uint64((start * 1_000_003 + step + 1) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows to the centers of every start: starts x rows x centers."""
    flat = centers.reshape(-1, x.shape[1])
    far = (x**2).sum(1)[:, None] + (flat**2).sum(1)[None, :] - 2.0 * x @ flat.T
    return np.maximum(far, 0.0).reshape(len(x), *centers.shape[:2]).transpose(1, 0, 2)


def _blocks(narrow: DataFrame) -> DataFrame:
    """(code, x): the codes and the features, row by row, of up to ``BLOCK_ROWS`` rows as binary. Rounds read these many times."""
    narrow.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, x = batch.column(0).to_numpy(), np.column_stack([c.to_numpy() for c in batch.columns[1:]])
            cuts = range(0, len(x), BLOCK_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array([v[low:low + BLOCK_ROWS].tobytes() for low in cuts], pa.binary()) for v in (codes, x)],
                                             ["code", "x"])
    return narrow.mapInArrow(pack, "code binary, x binary")


def _seeds(frame: DataFrame, width: int, k: int, starts: int, far_apart: bool) -> np.ndarray:
    """First centers of all starts: starts x k x features. One pass per center over the blocks; a row wins its start's draw
    with a chance in proportion to its squared distance from the centers so far, or to 1."""
    centers = None
    for step in range(k):
        known = centers

        def draw(batches, known=known, step=step):
            for code, block in ((c.as_py(), v.as_py()) for batch in batches for c, v in zip(*batch.columns)):
                x, codes = np.frombuffer(block).reshape(-1, width), np.frombuffer(code, np.int64)
                near = None if known is None else _squares(x, known).min(2)
                out = []
                for start in range(starts):
                    race = -np.log(_uniform(codes, start, step))
                    if near is not None:
                        open_ = near[start] > 1e-12 * (1.0 + (x**2).sum(1))
                        race = np.where(open_, race / np.where(open_ & far_apart, near[start], 1.0), np.inf)
                    i = int(race.argmin())
                    if np.isfinite(race[i]):
                        out.append((start, float(race[i]), x[i].tolist()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.float64(), pa.list_(pa.float64())))],
                                                     ["start", "race", "v"])

        won = frame.mapInArrow(draw, "start int, race double, v array<double>").groupBy("start").agg(
            F.min_by("v", F.struct("race", "v")).alias("v")).collect()  # one row per start
        if centers is None:
            if not won:
                return np.zeros((0, k, 0))
            centers = np.zeros((starts, 0, len(won[0]["v"])))
        new = {r["start"]: r["v"] for r in won}
        # with fewer distinct rows than centers the first center is repeated and stays empty
        centers = np.concatenate([centers, np.array([new.get(i, centers[i, :1].ravel()) for i in range(starts)])[:, None, :]], 1)
    return centers


def _nearest_of(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Nearest center of every row (the first of equals) from ``_weights`` of one start or several: (starts x) rows."""
    starts, k = weights.shape[:2]
    if k > FEW_CENTERS:
        return np.stack([(rows @ w.T).argmax(1) for w in weights])
    near = (weights.reshape(starts * k, -1) @ rows.T).reshape(starts, k, -1)
    label, best = np.zeros((starts, len(rows)), np.int8), near[:, 0].copy()
    for c in range(1, k):
        np.copyto(label, c, where=near[:, c] > best)
        np.maximum(best, near[:, c], out=best)
    return label


def _weights(centers: np.ndarray) -> np.ndarray:
    """Rows (with a one) times these are largest at the nearest center: its doubled coordinates, and less its square."""
    return np.concatenate([2.0 * centers, -(centers**2).sum(-1, keepdims=True)], -1)


def _assigned(frame: DataFrame, centers: np.ndarray, costs: bool = False) -> list:
    """Per start and cluster: rows, sums of the features and, if asked, of squared distances, all starts in one pass over the blocks."""
    starts, k, d = centers.shape
    weights, step = _weights(centers), max(64, ROUND_CELLS // (starts * k))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cost = np.zeros((starts, k, d + 1)), np.zeros((starts, k))
        for block in (v.as_py() for batch in batches for v in batch.column(0)):
            whole = np.frombuffer(block).reshape(-1, d)
            whole = np.concatenate([whole, np.ones((len(whole), 1))], 1)
            for low in range(0, len(whole), step):
                x = whole[low:low + step]
                label = _nearest_of(x, weights)
                if k > FEW_CENTERS:
                    for start, own in enumerate(label):
                        for i in range(d + 1):
                            sums[start, :, i] += np.bincount(own, x[:, i], k)
                else:
                    for c in range(k):
                        sums[:, c] += (label == c).astype(float) @ x
                if costs:
                    for start, own in enumerate(label):
                        cost[start] += np.bincount(own, ((x[:, :d] - centers[start][own]) ** 2).sum(1), k)
        n = sums[..., d].ravel()
        kept = np.flatnonzero(n)
        if len(kept):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept.astype(np.int32)), pa.array(n[kept].astype(np.int64)),
                 pa.array(list(sums.reshape(-1, d + 1)[kept, :d]), pa.list_(pa.float64())), pa.array(cost.ravel()[kept])],
                ["slot", "n", "total", "cost"])

    found = frame.select("x").mapInArrow(add, "slot int, n long, total array<double>, cost double")
    return found.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                                     F.array(*[F.sum(F.col("total")[i]) for i in range(d)]).alias("total")).collect()


def _whole(features: Sequence[str]) -> tuple[list, Column]:
    """The features as doubles, and whether a row has them all."""
    columns, whole = [as_column(f).cast("double") for f in features], F.lit(True)
    for c in columns:
        whole = whole & c.isNotNull() & ~F.isnan(c)
    return columns, whole


def kmeans(df: DataFrame, features: Sequence[str], k: int = 3, init: str = "random", n_init: int = 10,
           max_iter: int = 300, tol: float = 1e-4, seed: int = 42):
    """The best of ``n_init`` starts: (rows with ``cluster``, centers, inertia).

    All starts advance together, one pass over the stored features per round; a start ends, and
    leaves the pass, when the squared moves of its centers sum to at most ``tol`` times the mean
    variance. ``init`` is "random" (distinct rows) or "far apart" (chance by squared distance);
    draws depend on the rows' values and the seed, not on their order. Rows with a missing feature take no part and
    get a null cluster; without rows there are no centers. A batch of rows holds ``n_init * k`` distances per row.
    """
    columns, whole = _whole(features)
    coded = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    narrow = df.where(whole).select(F.xxhash64(*coded, F.lit(seed)).alias("code"), *[c.alias(f"x{i}") for i, c in enumerate(columns)])
    with reused(_blocks(narrow)) as frame:
        spread = narrow.agg(*[F.var_pop(f"x{i}") for i in range(len(features))]).first()
        centers = _seeds(frame, len(features), k, n_init, init != "random")
        if not len(centers):
            return df.withColumn("cluster", F.lit(None).cast("int")), [], 0.0
        limit, running = tol * sum(spread) / len(features), np.arange(n_init)
        for _ in range(max_iter):
            moved = centers[running].reshape(-1, len(features)).copy()
            for r in _assigned(frame, centers[running]):
                moved[r["slot"]] = np.array(r["total"]) / r["n"]
            moved = moved.reshape(-1, k, len(features))
            shift = ((moved - centers[running]) ** 2).sum((1, 2))
            centers[running] = moved
            running = running[shift > limit]
            if not len(running):
                break
        cost = np.zeros(n_init)
        for r in _assigned(frame, centers, costs=True):
            cost[r["slot"] // k] += r["cost"]
    best = int((cost <= cost.min() * (1 + 1e-9)).argmax())  # of equal starts the first, whatever the rounding
    listed = [[float(v) for v in c] for c in centers[best]]
    labels = distance_join(df, features, listed).drop("distance")
    return labels.withColumn("cluster", F.when(whole, F.col("cluster"))), listed, float(cost[best])


def kmeans_pp(df: DataFrame, features: Sequence[str], k: int = 3, n_init: int = 10, **options):
    """K-means seeded far apart: each further center is drawn by squared distance from those before it."""
    return kmeans(df, features, k, "far apart", n_init, **options)


def lloyd_step(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Assign every row to its nearest center: size, new mean and inertia per cluster, in one pass."""
    return distance_join(df, features, centers).groupBy("cluster").agg(
        F.count("*").alias("size"), *[F.avg(as_column(f)).alias(f"mean_{f}") for f in features],
        F.sum(F.col("distance") * F.col("distance")).alias("inertia"))


def seed_weights(df: DataFrame, key: str, features: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Chance of each row to become the next seed: its squared distance over the sum of them."""
    near = distance_join(df, features, centers).withColumn("_w", F.col("distance") * F.col("distance"))
    total = one_row(near.agg(F.sum("_w").alias("t")))
    return near.withColumn("_t", total).select(as_column(key), "distance", (F.col("_w") / F.col("_t.t")).alias("weight"))


def cluster_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(as_column(label).alias("cluster")).agg(F.count("*").alias("count"))


def ward_merge_cost(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Growth of within-cluster variance if clusters a and b merged, for every pair of clusters.

    The pairs are formed from one array of cluster summaries, so only clusters meet, never rows.
    """
    per = df.groupBy(as_column(label).alias("c")).agg(
        F.count("*").alias("n"), F.array(*[F.avg(as_column(f)) for f in features]).alias("m"))
    listed = per.agg(F.sort_array(F.collect_list(F.struct("c", "n", "m"))).alias("all"))
    pairs = listed.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b"))
    pairs = pairs.where(F.col("a.c") < F.col("b.c"))
    gap = F.aggregate(F.zip_with("a.m", "b.m", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
    na, nb = F.col("a.n").cast("double"), F.col("b.n").cast("double")
    return pairs.select(F.col("a.c").alias("a"), F.col("b.c").alias("b"), (na * nb / (na + nb) * gap).alias("cost"))


# ---- DBSCAN -----------------------------------------------------------------

def core_points(df: DataFrame, key: str, features: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """Rows within eps of each row, itself included, and whether that makes it a core point."""
    counts = neighbor_counts(df, key, features, eps).select(
        *[F.col(f"x{i}").alias(f"_x{i}") for i, _ in enumerate(features)], "neighbors")
    same = F.lit(True)
    for i, f in enumerate(features):
        same = same & (as_column(f).cast("double") == F.col(f"_x{i}"))
    return df.join(counts, same).select(as_column(key), "neighbors", (F.col("neighbors") >= min_samples).alias("core"))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest node of each component as its name.

    Every round hooks parents onto the smallest grandparent seen next door and then halves
    the paths, so the rounds grow with the logarithm of the longest chain. Each round is
    written to the checkpoint folder.
    """
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = cut_lineage(both)
    labels = cut_lineage(nodes.select("node", F.col("node").alias("parent")))
    while True:
        up = labels.select(F.col("node").alias("_n"), F.col("parent").alias("grand"))
        grand = labels.join(up, F.col("parent") == F.col("_n")).select("node", "parent", "grand")
        around = both.join(grand.select(F.col("node").alias("dst"), F.col("grand").alias("seen")), "dst")
        least = around.groupBy("src").agg(F.min("seen").alias("seen"))
        offer = grand.join(least, grand["node"] == least["src"], "left")
        offers = offer.select(F.inline(F.array(
            F.struct(F.col("node").alias("node"), F.col("grand").alias("low")),
            F.struct(F.col("node").alias("node"), F.coalesce("seen", "grand").alias("low")),
            F.struct(F.col("parent").alias("node"), F.coalesce("seen", "grand").alias("low")))))
        lowest = offers.groupBy("node").agg(F.min("low").alias("low"))
        following = cut_lineage(labels.join(lowest, "node").select(
            "node", F.least("parent", "low").alias("parent"), (F.col("low") < F.col("parent")).alias("moved")))
        moved = following.where("moved").limit(1).count()
        labels = following.select("node", "parent")
        if not moved:
            return labels.withColumnRenamed("parent", "component")


def _of_cells(rows: DataFrame, cells: DataFrame, d: int, few: bool, how: str = "inner") -> DataFrame:
    """The rows with what the table of cells (_c0.., more) says of their cell; only a short table is sent to all tasks."""
    codes = [f"_c{i}" for i in range(d)]
    return rows.join(F.broadcast(cells), codes, how) if few else rows.hint("merge").join(cells, codes, how)


def _cell_parts(nodes: DataFrame, pairs: DataFrame, core_rows: Callable[[DataFrame], DataFrame], d: int, eps: float) -> DataFrame:
    """(node, component) of cells linked by core points within eps of each other, of the ``pairs`` (a_cell, b_cell, a_n, b_n, sure).

    Bounding boxes settled the sure ones. For the rest the cells are halved a few times and the
    boxes asked again; pairs that other links already connect are left out, and what is still open is compared
    point by point. ``core_rows`` gives the core points of listed cells.
    """
    names = [f"x{i}" for i in range(d)]
    links = pairs.where("sure").select(F.col("a_cell").alias("src"), F.col("b_cell").alias("dst"))
    rest = pairs.where(~F.col("sure")).select("a_cell", "b_cell", "a_n", "b_n")
    width = eps / math.sqrt(d)
    slack = 1e-9 * eps * eps

    parts = None

    def core():
        return core_rows(rest.select(F.col("a_cell").alias("cell")).union(rest.select("b_cell")).distinct())

    for level in range(1, 6):
        work = rest.agg(F.sum(F.col("a_n").cast("double") * F.col("b_n")).alias("w")).first()["w"]
        if not work:
            return connected_components(nodes, links) if parts is None else parts
        if work <= DIRECT_PAIRS or level == 5:
            break
        step = width / 2**level
        # the boxes of a task are formed before anything is sent
        boxes = core().groupBy(F.col("cell").alias("whole"), *[F.floor(F.col(n) / step).alias(f"s{i}") for i, n in enumerate(names)]).agg(
            *[F.min(n).alias(f"lo{i}") for i, n in enumerate(names)], *[F.max(n).alias(f"hi{i}") for i, n in enumerate(names)])
        boxes = write_out(boxes, "boxes")
        ends = [f"{s}{i}" for i in range(d) for s in ("lo", "hi")]
        a = boxes.select(F.col("whole").alias("a_cell"), *[F.col(e).alias(f"a_{e}") for e in ends])
        b = boxes.select(F.col("whole").alias("b_cell"), *[F.col(e).alias(f"b_{e}") for e in ends])
        asked = (rest.join(a, "a_cell").join(b, "b_cell")
                 .where(_box_gap(d, "a_", "b_") <= F.lit(eps * eps + slack))
                 .groupBy("a_cell", "b_cell", "a_n", "b_n")
                 .agg(F.bool_or(_box_reach(d, "a_", "b_") <= F.lit(eps * eps - slack)).alias("sure")))
        asked = write_out(asked, "asked")
        links = links.unionByName(asked.where("sure").select(F.col("a_cell").alias("src"), F.col("b_cell").alias("dst")))
        parts = connected_components(nodes, links)
        a = parts.select(F.col("node").alias("a_cell"), F.col("component").alias("_a"))
        b = parts.select(F.col("node").alias("b_cell"), F.col("component").alias("_b"))
        rest = asked.where(~F.col("sure")).join(a, "a_cell").join(b, "b_cell").where("_a <> _b").select("a_cell", "b_cell", "a_n", "b_n")
    points = write_out(core().distinct(), "points")
    left = points.select(F.col("cell").alias("a_cell"), *names)
    right = points.select(F.col("cell").alias("b_cell"), *[F.col(n).alias(f"o{n}") for n in names])
    close = (rest.select("a_cell", "b_cell").join(left, "a_cell").join(right, "b_cell")
             .where(euclidean(names, [f"o{n}" for n in names]) <= F.lit(float(eps)))
             .select(F.col("a_cell").alias("src"), F.col("b_cell").alias("dst")).distinct())
    return connected_components(nodes, links.unionByName(close))


def dbscan(df: DataFrame, key: str, features: Sequence[str], eps: float = 0.8, min_samples: int = 10,
           out: str = "cluster") -> DataFrame:
    """Add the cluster number of each row, -1 for noise, and its ``kind`` (core, border, noise).

    Clusters are numbered by their smallest core id; a border row joins the lowest-numbered
    cluster that reaches it. Runs on all rows, as several jobs. Cells whose points all lie within eps of each
    other are summed up first. A cell with ``min_samples`` rows in sure reach holds only core points and one cluster: its rows never
    leave their task. Only cells left open by their neighbours' counts and boxes are opened, copies of a position as one.
    Rows are told apart by position, so rows that share an id count each.
    """
    d = len(features)
    names, codes = [f"x{i}" for i in range(d)], [f"_c{i}" for i in range(d)]
    others = [f"o{n}" for n in names]
    columns, whole = _whole(features)
    within = euclidean(names, others) <= F.lit(float(eps))
    rows = df.where(whole).select(as_column(key).alias("id"), *[c.alias(n) for n, c in zip(names, columns)])
    rows = rows.select("id", *names, *[c.alias(n) for n, c in zip(codes, cell_codes(names, eps))])
    cells = rows.groupBy(*codes).agg(F.count("*").alias("n"), F.min("id").alias("first"),
                                     *[F.min(n).alias(f"lo{i}") for i, n in enumerate(names)], *[F.max(n).alias(f"hi{i}") for i, n in enumerate(names)])
    cells = write_out(cells.withColumn("cell", F.monotonically_increasing_id()), "cells")
    few = cells.count() <= LISTED_CELLS
    cells = cells if few else cells.hint("merge")  # a file's size is far below that of its rows, so Spark would broadcast millions

    # 2: only core points, 0: none, 1: open
    pairs = write_out(near_cells(cells, d, eps), "pairs")
    around = pairs.where(F.col("a_n") < min_samples).groupBy(F.col("a_cell").alias("cell")).agg(
        F.sum(F.when(F.col("sure"), F.col("b_n"))).alias("_sure"), F.sum(F.when(~F.col("sure"), F.col("b_n"))).alias("_open"))
    known = F.col("n") + F.coalesce("_sure", F.lit(0))
    state = F.when(known >= min_samples, 2).when(known + F.coalesce("_open", F.lit(0)) < min_samples, 0).otherwise(1)
    cells = write_out(cells.join(around, "cell", "left").select("cell", *codes, "first", known.alias("known"), state.alias("state")), "states")
    cells = cells if few else cells.hint("merge")
    pairs = pairs.join(cells.select(F.col("cell").alias("a_cell"), F.col("state").alias("a_state")), "a_cell").join(
        cells.select(F.col("cell").alias("b_cell"), F.col("state").alias("b_state")), "b_cell")
    # a pair is asked for links once, and for the rows that may not be core from their side
    linked = (F.col("a_cell") < F.col("b_cell")) & (F.col("a_state") > 0) & (F.col("b_state") > 0)
    pairs = write_out(pairs.where(linked | ((F.col("a_state") < 2) & (F.col("a_state") + F.col("b_state") > 0))), "pairs")
    loose = pairs.where(F.col("a_state") < 2).select("a_cell", "b_cell", "a_state", "sure")
    dense = cells.where("state = 2")
    firsts = dense.select("cell", "first")
    candidates = pairs.where(linked)

    opened = bool(loose.limit(1).count())
    if opened:
        listed = loose.select(F.col("a_cell").alias("cell")).union(loose.where(~F.col("sure")).select("b_cell")).distinct()
        points = _of_cells(rows, cells.join(listed, "cell").select(*codes, "cell", "known", "state"), d, few)
        points = write_out(points.groupBy("cell", "known", "state", *names).agg(
            F.count("*").alias("weight"), F.min("id").alias("id")).withColumn("spot", F.monotonically_increasing_id()), "points")
        asked = points.where("state = 1").select("cell", "spot", "id", "known", *names)
        other = points.select(F.col("cell").alias("b_cell"), F.col("weight").alias("_w"), *[F.col(n).alias(o) for n, o in zip(names, others)])
        close = (asked.join(loose.where((F.col("a_state") == 1) & ~F.col("sure")).select(F.col("a_cell").alias("cell"), "b_cell"), "cell")
                 .join(other, "b_cell").where(within).groupBy("spot").agg(F.sum("_w").alias("_close")))
        mixed = write_out(asked.join(close, "spot", "left").where(F.col("known") + F.coalesce("_close", F.lit(0)) >= min_samples)
                          .select("cell", "spot", "id", *names), "mixed")
        firsts = firsts.unionByName(mixed.groupBy("cell").agg(F.min("id").alias("first")))
        candidates = (candidates.join(firsts.select(F.col("cell").alias("a_cell")), "a_cell", "left_semi")
                      .join(firsts.select(F.col("cell").alias("b_cell")), "b_cell", "left_semi"))

    def core_rows(listed: DataFrame) -> DataFrame:
        found = _of_cells(rows, dense.join(listed, "cell").select(*codes, "cell"), d, few).select("cell", *names)
        return found.unionByName(mixed.join(listed, "cell").select("cell", *names)) if opened else found

    candidates = candidates.select("a_cell", "b_cell", "a_n", "b_n", "sure")
    parts = _cell_parts(firsts.select(F.col("cell").alias("node")), candidates, core_rows, d, eps).withColumnRenamed("node", "cell")
    roots = firsts.join(parts, "cell").groupBy("component").agg(F.min("first").alias("first"))
    # one row per cluster; numbering them needs their order, not the rows'
    numbered = roots.withColumn("number", (F.row_number().over(Window.orderBy("first")) - 1).cast("int"))
    numbers = write_out(parts.join(numbered, "component").select("cell", "number"), "numbers")

    marks = dense.join(numbers, "cell").select(*codes, "number", F.lit(False).alias("open"))
    if opened:
        marks = marks.unionByName(cells.join(loose.select(F.col("a_cell").alias("cell")).distinct(), "cell").select(
            *codes, F.lit(None).cast("int").alias("number"), F.lit(True).alias("open")))
    marks = write_out(marks.withColumnsRenamed({"number": "_number", "open": "_open"}), "marks")
    kept = [as_column(c) for c in df.columns if c not in (out, "kind")]
    # a row that lacks a coordinate has no cell and reaches nobody: noise
    placed = df.select(*kept, *[F.when(whole, c).alias(f"_{n}") for n, c in zip(names, columns)])
    placed = placed.select("*", *[c.alias(n) for n, c in zip(codes, cell_codes([f"_{n}" for n in names], eps))])
    marked = _of_cells(placed, marks, d, few, "left")
    kind = F.when(F.col("_number").isNull(), "noise").otherwise("core")
    labelled = marked.where(~F.coalesce("_open", F.lit(False))).select(*kept, "_number", kind.alias("_kind"))
    if opened:
        free = points.where("state < 2").join(mixed.select("spot"), "spot", "left_anti").select("cell", "spot", *names)
        beside = loose.join(numbers.select(F.col("cell").alias("b_cell"), "number"), "b_cell")
        beside = beside.select(F.col("a_cell").alias("cell"), "b_cell", "sure", "number")
        # a cell's own core points reach its other points; neighbouring cells are asked by distance
        by_cell = numbers.unionByName(beside.where("sure").select("cell", "number")).groupBy("cell").agg(F.min("number").alias("number"))
        spots = points.where("state = 2").select("cell", *names).unionByName(mixed.select("cell", *names))
        spots = spots.select(F.col("cell").alias("b_cell"), *[F.col(n).alias(o) for n, o in zip(names, others)])
        across = free.join(beside.where(~F.col("sure")).drop("sure"), "cell").join(spots, "b_cell").where(within)
        border = free.join(by_cell, "cell").select("spot", "number").unionByName(across.select("spot", "number"))
        border = free.join(border.groupBy("spot").agg(F.min("number").alias("number")), "spot")
        own = [F.col(n).alias(f"_{n}") for n in names]
        found = write_out(mixed.join(numbers, "cell").select(*own, F.col("number").alias("_number"), F.lit("core").alias("_kind")).unionByName(
            border.select(*own, F.col("number").alias("_number"), F.lit("border").alias("_kind"))), "found")
        rest = marked.where("_open").drop("_number", "_open").join(found, [f"_{n}" for n in names], "left")
        labelled = labelled.unionByName(rest.select(*kept, "_number", F.coalesce("_kind", F.lit("noise")).alias("_kind")))
    return labelled.select(*kept, F.coalesce("_number", F.lit(-1)).alias(out), F.col("_kind").alias("kind"))


# ---- hierarchical -----------------------------------------------------------

def _ward_merges(sizes: np.ndarray, means: np.ndarray) -> list[tuple[int, int, int, float, int]]:
    """Merge steps (step, left, right, height, size) of weighted centers."""
    n = len(sizes)
    ids, size, mean = list(range(n)), sizes.astype(float).copy(), means.astype(float).copy()
    square = ((mean[:, None, :] - mean[None, :, :]) ** 2).sum(2)
    cost = size[:, None] * size[None, :] / (size[:, None] + size[None, :]) * square
    np.fill_diagonal(cost, np.inf)
    steps = []
    for step in range(n - 1):
        i, j = np.unravel_index(np.argmin(cost), cost.shape)
        i, j = min(i, j), max(i, j)
        height = math.sqrt(2.0 * cost[i, j])
        mean[i] = (size[i] * mean[i] + size[j] * mean[j]) / (size[i] + size[j])
        size[i] += size[j]
        steps.append((step + 1, min(ids[i], ids[j]), max(ids[i], ids[j]), height, int(size[i])))
        ids[i] = n + step
        row = size[i] * size / (size[i] + size) * ((mean - mean[i]) ** 2).sum(1)
        row[~np.isfinite(cost[i])] = np.inf
        row[[i, j]] = np.inf
        cost[i, :], cost[:, i] = row, row
        cost[j, :], cost[:, j] = np.inf, np.inf
    return steps


def _cheapest(sizes: np.ndarray, means: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Partner with the least Ward cost of each cluster ``asked`` (of equal ones the first) and that cost."""
    partner, least = np.zeros(len(asked), np.int64), np.full(len(asked), np.inf)
    for lo in range(0, len(asked), WARD_STEP[0]):
        mine = asked[lo:lo + WARD_STEP[0]]
        rows = np.arange(len(mine))
        for at in range(0, len(sizes), WARD_STEP[1]):
            other = slice(at, at + WARD_STEP[1])
            square = np.zeros((len(mine), len(sizes[other])))
            for i in range(means.shape[1]):
                square += (means[mine, i][:, None] - means[other, i][None, :]) ** 2
            # the same value from both ends, as products and sums of two numbers commute
            cost = sizes[mine][:, None] * sizes[other][None, :] / (sizes[mine][:, None] + sizes[other][None, :]) * square
            inside = (mine >= at) & (mine < at + cost.shape[1])
            cost[rows[inside], mine[inside] - at] = np.inf
            j = cost.argmin(1)
            found = cost[rows, j]
            better = found < least[lo:lo + len(mine)]
            least[lo:lo + len(mine)][better] = found[better]
            partner[lo:lo + len(mine)][better] = (j + at)[better]
    return partner, least


def _cheapest_spread(spark, sizes: np.ndarray, means: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_cheapest`` in tasks of ``WARD_PAIRS`` pairs, or at once where there are no more than that."""
    tasks = min(len(asked), -(-len(asked) * len(sizes) // WARD_PAIRS))
    if tasks <= 1:
        return _cheapest(sizes, means, asked)
    shared = spark.sparkContext.broadcast((sizes, means, asked))

    def work(batches):
        for pdf in batches:
            for task in pdf["id"]:
                sizes, means, asked = shared.value
                mine = np.arange(task, len(asked), tasks)
                partner, least = _cheapest(sizes, means, asked[mine])
                yield pd.DataFrame({"row": mine, "partner": partner, "least": least})

    found = spark.range(0, tasks, 1, tasks).mapInPandas(work, "row long, partner long, least double").toPandas().sort_values("row")
    shared.destroy()
    return found["partner"].to_numpy(), found["least"].to_numpy()


def _ward_rounds(spark, sizes: np.ndarray, means: np.ndarray) -> list[tuple[int, int, int, float, int]]:
    """The steps of ``_ward_merges`` by rounds that merge all pairs of clusters cheapest to each other.

    Ward costs never fall below those of the parts merged, so pairs that are each other's cheapest are merged by the plain
    order too, and only clusters whose partner was merged look for another one. Memory grows with the clusters, not with
    their pairs; the search for partners runs in tasks. Equal costs go to the lower numbers.
    """
    n = len(sizes)
    name, size, mean = np.arange(n), sizes.astype(float), means.astype(float)
    partner, least = _cheapest_spread(spark, size, mean, np.arange(n))
    merges, height = [], {}
    while len(size) > 1:
        at = np.arange(len(size))
        first = at[(partner[partner] == at) & (at < partner)]
        if not len(first):  # rounding alone can hide the cheapest pair from a partner found in an earlier round
            partner, least = _cheapest_spread(spark, size, mean, at)
            continue
        second = partner[first]
        both = size[first] + size[second]
        center = (size[first, None] * mean[first] + size[second, None] * mean[second]) / both[:, None]
        made = n + len(merges) + np.arange(len(first))
        for a, b, c, cost, rows in zip(name[first].tolist(), name[second].tolist(), made.tolist(), least[first].tolist(), both.tolist()):
            height[c] = max(math.sqrt(2.0 * cost), height.get(a, 0.0), height.get(b, 0.0))
            merges.append((height[c], c, a, b, int(rows)))
        gone = np.zeros(len(size), bool)
        gone[first] = gone[second] = True
        lost = gone[partner[~gone]]
        place = np.cumsum(~gone) - 1
        partner = np.concatenate([np.where(lost, -1, place[partner[~gone]]), np.full(len(first), -1)])
        least = np.concatenate([least[~gone], np.full(len(first), np.inf)])
        name, size = np.concatenate([name[~gone], made]), np.concatenate([size[~gone], both])
        mean = np.concatenate([mean[~gone], center])
        asked = np.flatnonzero(partner < 0)
        if len(size) > 1:
            partner[asked], least[asked] = _cheapest_spread(spark, size, mean, asked)
    merges.sort()
    number = {**{i: i for i in range(n)}, **{c: n + step for step, (_, c, *_) in enumerate(merges)}}
    return [(step + 1, min(number[a], number[b]), max(number[a], number[b]), h, rows)
            for step, (h, _, a, b, rows) in enumerate(merges)]


def _first_centers(frame: DataFrame, width: int, micro: int, seed: int) -> np.ndarray:
    """At most ``micro`` distinct rows, drawn by a hash of their values."""
    names = [f"x{i}" for i in range(width)]
    code = F.xxhash64(*names, F.lit(seed))
    n = frame.count()
    share = min(1.0, 50.0 * micro / max(n, 1))
    for part in ([share] if share < 1 else []) + [1.0]:
        some = frame if part == 1 else frame.where(F.pmod(code, F.lit(1 << 30)) < int(part * (1 << 30)))
        rows = some.select(*names).distinct().orderBy(code, *names).limit(micro).collect()
        if len(rows) >= micro:
            break
    return np.array([list(r) for r in rows], float).reshape(-1, width)


def _micro_centers(df: DataFrame, features: Sequence[str], micro: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and means of ``micro`` k-means groups of the rows, or of the distinct rows if ``micro`` is 0."""
    columns, whole = _whole(features)
    plain = df.where(whole).select(*[c.alias(f"x{i}") for i, c in enumerate(columns)])
    if micro:
        with reused(_blocks(plain.select(F.lit(0).cast("long").alias("code"), *plain.columns))) as frame:
            centers = _first_centers(plain, len(features), micro, seed)
            if not len(centers):
                return np.zeros(0), centers
            for _ in range(CONDENSE_ROUNDS):
                moved = centers.copy()
                for r in _assigned(frame, centers[None]):
                    moved[r["slot"]] = np.array(r["total"]) / r["n"]
                still, centers = np.array_equal(moved, centers), moved
                if still:
                    break
            count = {r["slot"]: r["n"] for r in _assigned(frame, centers[None])}
        kept = sorted(count)
        return np.array([count[i] for i in kept]), centers[kept]
    distinct = plain.groupBy(*plain.columns).agg(F.count("*").alias("n"))
    rows = sorted(distinct.collect(), key=lambda r: tuple(r)[:-1])
    return np.array([r["n"] for r in rows]), np.array([list(r)[:-1] for r in rows])


def hierarchical(df: DataFrame, features: Sequence[str], k: int = 3, mode: str = "condensed", micro: int = 1000,
                 seed: int = 42, out: str = "cluster") -> tuple[DataFrame, DataFrame]:
    """Ward clustering of all rows: (rows with ``cluster``, merge table).

    ``mode="condensed"``: k-means first condenses the rows, however many there are, to ``micro`` weighted
    centers and Ward merges those, which is approximate. ``mode="exact"``: Ward merges the distinct rows, which the
    driver holds (a few numbers each); all pairs of them are compared, in tasks where they are many. Clusters are numbered by size,
    largest first.
    """
    if mode not in ("exact", "condensed"):
        raise ValueError(f"unknown mode {mode}")
    sizes, means = _micro_centers(df, features, micro if mode == "condensed" else 0, seed)
    n = len(sizes)
    steps = _ward_merges(sizes, means) if n <= WARD_PLAIN else _ward_rounds(df.sparkSession, sizes, means)
    group = {i: [i] for i in range(n)}
    for step, left, right, _, _ in steps[:max(0, n - k)]:
        group[n + step - 1] = group.pop(left) + group.pop(right)
    order = sorted(group.values(), key=lambda g: (-int(sizes[g].sum()), min(g)))
    number = [0] * n
    for c, members in enumerate(order):
        for i in members:
            number[i] = c
    labels = distance_join_many(df, features, means, out, number)
    table = small_frame(df.sparkSession, [(s, l, r, float(h), z) for s, l, r, h, z in steps],
                        "step int, left int, right int, height double, size long")
    return labels, table


def distance_join_many(df: DataFrame, features: Sequence[str], centers: np.ndarray, out: str, number: Sequence[int]) -> DataFrame:
    """``number`` of the nearest of many centers, some rows at a time; null for a row that lacks a feature."""
    columns, whole = _whole(features)
    if not len(centers):
        return df.withColumn(out, F.lit(None).cast("int"))
    number, weights = np.array(number, np.int32), _weights(centers[None])
    step = max(64, ROUND_CELLS // len(centers))

    @F.pandas_udf("int")
    def nearest(*columns: pd.Series) -> pd.Series:
        rows = np.column_stack([*columns, np.ones(len(columns[0]))])
        found = [_nearest_of(rows[low:low + step], weights)[0] for low in range(0, len(rows), step)]
        return pd.Series(number[np.concatenate(found)] if found else np.empty(0, np.int32))

    return df.withColumn(out, F.when(whole, nearest(*[F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)) for c in columns])))


def dendrogram_table(df: DataFrame, features: Sequence[str], n: int = 120, seed: int = 42) -> DataFrame:
    """The merge steps and heights of n weighted centers of the table."""
    return hierarchical(df, features, k=1, micro=n, seed=seed)[1]
