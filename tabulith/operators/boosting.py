"""Boosted histogram trees on DataFrames: AdaBoost and second-order (Newton) boosting.

Features are cut into quantile bins once; the rows stay cached with their bins, label and current margin or weight. Growing a tree by
one level is one job: tasks route their rows through the tree so far and sum histograms of (feature, bin) for the
smaller child of every split; the sums of all tasks meet by node, where the larger child's histogram is the stored one of the parent minus the
smaller child's, and where each node's best split is chosen. Only one row per node reaches the driver. A finished tree moves
the margins or weights in the next job that reads the rows.

Rows of one block (``ROW_BLOCK``) are read by one task anyway. There all trees are grown in one job, by the same steps, and only the
trees reach the driver (``Block``).
"""

from __future__ import annotations

import heapq
import math
import pickle
import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import as_column, sigmoid
from ..runtime import cut_lineage, small_frame
from .ordering import _edges
from .trees import importance_table

ROW_BLOCK = 500_000  # rows of a cached partition
TREE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double"


@dataclass
class Node:
    id: int
    value: float
    feature: int = -1
    bin: int = -1
    threshold: float = 0.0
    gain: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None
    a: float = 0.0  # sums over the node's rows
    b: float = 0.0

    def all(self) -> Iterator["Node"]:
        yield self
        for child in (self.left, self.right):
            if child is not None:
                yield from child.all()


def _bin_features(df: DataFrame, features: Sequence[str], max_bins: int) -> tuple[DataFrame, list[list[float]]]:
    """Add small-integer columns _b0.. ; a missing value falls into the last bin and so goes right."""
    names = [f"_f{i}" for i, _ in enumerate(features)]
    raw = df.withColumns({n: as_column(c).cast("double") for n, c in zip(names, features)})
    found = _edges(raw, names, max_bins)
    edges = [found[n] for n in names]
    binned = Bucketizer(splitsArray=edges, inputCols=names, outputCols=[f"_b{i}" for i, _ in enumerate(features)],
                        handleInvalid="keep").transform(raw)
    return binned.withColumns({f"_b{i}": F.col(f"_b{i}").cast("short") for i, _ in enumerate(features)}).drop(*names), edges


def newton_gain(lam: float, min_weight: float):
    """Second-order gain of every split; a, b = sums of gradients and hessians."""
    def gain(left_a, left_b, a, b):
        right_a, right_b = a - left_a, b - left_b
        value = left_a**2 / (left_b + lam) + right_a**2 / (right_b + lam) - a**2 / (b + lam)
        return np.where((left_b >= min_weight) & (right_b >= min_weight), value / 2, -np.inf)
    return gain


def gini_gain(left_a, left_b, a, b):
    """Drop of weighted Gini impurity; a = weight of positives, b = weight."""
    def impurity(pos, every):
        return 2 * pos * (1 - pos / every)
    right_a, right_b = a - left_a, b - left_b
    value = impurity(a, b) - impurity(left_a, left_b) - impurity(right_a, right_b)
    return np.where((left_b > 0) & (right_b > 0), value, -np.inf)


@dataclass
class Trunk:
    """A tree as arrays, for routing binned rows."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(root: Node) -> "Trunk":
        nodes = sorted(root.all(), key=lambda n: n.id)
        at = {n.id: i for i, n in enumerate(nodes)}
        own = np.arange(len(nodes))
        left, right = own.copy(), own.copy()
        for i, n in enumerate(nodes):
            if n.left is not None:
                left[i], right[i] = at[n.left.id], at[n.right.id]
        return Trunk(np.array([n.feature if n.left is not None else -1 for n in nodes]), np.array([n.bin for n in nodes]), left, right,
                     np.array([n.value for n in nodes]))

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = self.feature[at]
            if not (f >= 0).any():
                return at
            at = np.where(f < 0, at, np.where(bins[rows, np.maximum(f, 0)] <= self.bin[at], self.left[at], self.right[at]))


@dataclass
class Rows:
    """The cached rows: ``bins`` array<smallint>, ``y`` double, ``key`` bigint (a hash of the row's id), ``m`` double (margin or weight)."""

    frame: DataFrame
    width: int
    edges: list[list[float]]
    blocks: int = 1
    older: list[DataFrame] = field(default_factory=list)

    @staticmethod
    def of(labelled: DataFrame, label: str, features: Sequence[str], ids: Sequence[str], max_bins: int, start: float) -> "Rows":
        binned, edges = _bin_features(labelled, features, max_bins)
        key = F.xxhash64(*[as_column(c) for c in ids]) if ids else F.lit(0).cast("bigint")
        frame = binned.select(F.array(*[f"_b{i}" for i, _ in enumerate(features)]).alias("bins"),
                              as_column(label).cast("double").alias("y"), key.alias("key"), F.lit(float(start)).alias("m"))
        size = frame.count()
        # blocks that a task reads in a second or so: few rows are not worth many tasks per level
        blocks = max(1, -(-size // ROW_BLOCK))
        return Rows(_settle(frame.repartition(blocks)), len(features), edges, blocks)

    def boosted(self, rounds: int, grow: "Callable[[Rows | Block], list[tuple[float, Node]]]") -> list[tuple[float, Node]]:
        """The weighted trees that ``grow`` makes of the rows; several rounds on one block are one task."""
        if self.blocks > 1 or rounds < 2:
            return grow(self)
        width, edges = self.width, self.edges

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(*_arrays(b, width), b.column(2).to_numpy()) for b in batches if b.num_rows]
            none = (np.zeros((0, width), np.int16), np.zeros(0), np.zeros(0), np.zeros(0, np.int64))
            trees = grow(Block(*(np.concatenate(c) for c in zip(*parts or [none])), edges))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], ["trees"])

        return pickle.loads(self.frame.coalesce(1).mapInArrow(whole, "trees binary").first()["trees"])

    def move(self, change: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], settle: bool) -> None:
        """Replace ``m`` by change(bins, y, m); the job that reads the rows next does the work, unless they are settled now."""
        width = self.width

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, y, m = _arrays(batch, width)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(change(bins, y, m), pa.float64())], batch.schema.names)
        after = self.frame.mapInArrow(moved, self.frame.schema)
        if settle:
            self.older.append(self.frame)
            self.frame = _settle(after)
            self.release()
        else:
            self.older.append(self.frame)
            self.frame = after.persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        """Give back the memory of states that were replaced, once a job has read the present one."""
        _give_back(self.older)

    def close(self) -> None:
        self.release()
        self.frame.unpersist()


@dataclass
class Block:
    """The rows of a single block, in the task that grows all trees on them. It does what ``Rows`` and ``_level`` do with jobs."""

    bins: np.ndarray
    y: np.ndarray
    m: np.ndarray
    key: np.ndarray
    edges: list[list[float]]
    draw: tuple[int, np.ndarray] | None = None  # seed of the present tree, and the rows that it sees

    def move(self, change: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], settle: bool) -> None:
        self.m = change(self.bins, self.y, self.m)

    def release(self) -> None:
        pass

    close = release

    def level(self, trunk: Trunk, wanted: dict[int, tuple[int, int]], before: dict[int, np.ndarray], columns: Sequence[int], gradient, gain,
              min_rows: int, seed: int, subsample: float) -> tuple[dict[int, np.ndarray], list[dict]]:
        """Histograms by node, and rows as ``_level`` returns them; ``before`` has the parent's histogram by smaller child."""
        depth = max(len(self.edges[f]) for f in columns)
        slots = np.full(len(trunk.feature), -1)
        slots[list(wanted)] = np.arange(len(wanted))
        slot = slots[trunk.places(self.bins)]
        inside = slot >= 0
        if subsample < 1:
            if self.draw is None or self.draw[0] != seed:
                self.draw = seed, _drawn(self.key, seed, subsample)
            inside &= self.draw[1]
        some = np.flatnonzero(inside)
        sums = _histograms(self.bins[some], slot[some], *gradient(self.y[some], self.m[some]), columns, len(wanted), depth)
        held, found = {}, []
        for s, (node, sibling) in enumerate(wanted.values()):
            own = np.ascontiguousarray(sums[:, :, s * depth:(s + 1) * depth])
            if sibling >= 0:
                held[node], held[sibling] = own, before[node] - own
            elif own[2].any():
                held[node] = own
        for node, hist in held.items():
            a, b, n = hist[:, 0].sum(1)
            found.append(dict(zip(_SPLIT_NAMES, (node, None, a, b, n, *best_split(hist, gain, min_rows)))))
        return held, found


def _histograms(bins: np.ndarray, slot: np.ndarray, a: np.ndarray, b: np.ndarray, columns: Sequence[int], nodes: int, depth: int) -> np.ndarray:
    """Sums of (a, b, rows) by column and, side by side, the bins of every node."""
    sums = np.empty((3, len(columns), nodes * depth))
    for f, column in enumerate(columns):
        cell = slot * depth + bins[:, column]
        for i, weight in enumerate((a, b, None)):
            sums[i, f] = np.bincount(cell, weight, nodes * depth)
    return sums


def _arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
    return bins, batch.column(1).to_numpy(), batch.column(3).to_numpy()


def _drawn(key: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Which rows a tree sees: a fresh draw per seed from the rows' hashes."""
    with np.errstate(over="ignore"):
        h = key.view(np.uint64) + np.uint64(seed % (1 << 31) + 1) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) < np.uint64(min(share * 2.0**64, 2.0**64 - 2048))


def best_split(hist: np.ndarray, gain, min_rows: int) -> tuple[float, int, int, float, float, float]:
    """(gain, feature's place, bin, left a, left b, left rows) of a node's best split; ``hist`` is (a, b, rows) x feature x bin."""
    left = hist.cumsum(2)
    total = left[:, :, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.nan_to_num(gain(left[0], left[1], total[0], total[1]), nan=-np.inf)
    # rounded, so that equal splits tie whatever order the sums were taken in
    enough = (left[2] >= min_rows) & (total[2] - left[2] >= min_rows)
    value = np.where(enough, np.round(value, 10), -np.inf)[:, :-1]
    if not value.size:
        return -np.inf, -1, -1, 0.0, 0.0, 0.0
    f, at = np.unravel_index(int(value.argmax()), value.shape)
    return float(value[f, at]), int(f), int(at), *(float(left[i, f, at]) for i in range(3))


_PARTS = "node int, sibling int, whole boolean, hist binary"
_SPLITS = ("node int, hist binary, a double, b double, n double, gain double, feature int, bin int, left_a double, left_b double, "
           "left_n double")
_SPLIT_NAMES = [f.split()[0] for f in _SPLITS.split(", ")]


def _level(rows: Rows, trunk: Trunk, wanted: dict[int, tuple[int, int]], before: DataFrame | None, columns: Sequence[int], gradient,
           gain, min_rows: int, seed: int, subsample: float) -> DataFrame:
    """Histograms and best splits of the nodes ``wanted``: place of the smaller child -> (its number, its sibling's or -1)."""
    depth = max(len(rows.edges[f]) for f in columns)  # bins, one more for gaps
    shape, width = (3, len(columns), depth), rows.width
    slots = np.full(len(trunk.feature), -1)
    slots[list(wanted)] = np.arange(len(wanted))
    names = list(wanted.values())

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(columns), len(names) * depth))
        for batch in batches:
            bins, y, m = _arrays(batch, width)
            slot = slots[trunk.places(bins)]
            inside = slot >= 0
            if subsample < 1:
                inside &= _drawn(batch.column(2).to_numpy(), seed, subsample)
            some = np.flatnonzero(inside)
            sums += _histograms(bins[some], slot[some], *gradient(y[some], m[some]), columns, len(names), depth)
        parts = [np.ascontiguousarray(sums[:, :, s * depth:(s + 1) * depth]) for s in range(len(names))]
        kept = [s for s, p in enumerate(parts) if p[2].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[s][0] for s in kept], pa.int32()), pa.array([names[s][1] for s in kept], pa.int32()),
             pa.array([False] * len(kept)), pa.array([parts[s].tobytes() for s in kept], pa.binary())],
            ["node", "sibling", "whole", "hist"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small: dict[tuple[int, int], np.ndarray] = {}
        whole: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for node, sibling, is_whole, h in zip(*(c.to_pylist() for c in batch.columns)):
                found = np.frombuffer(h).reshape(shape)
                into = whole if is_whole else small
                into[node, sibling] = into[node, sibling] + found if (node, sibling) in into else found
        out = []
        for node, sibling in small.keys() | whole.keys():
            own = small.get((node, sibling), np.zeros(shape))
            pair = [(node, own)]
            if sibling >= 0:
                pair.append((sibling, whole[node, sibling] - own))
            for number, hist in pair:
                a, b, n = hist[:, 0].sum(1)
                out.append((number, hist.tobytes(), a, b, n, *best_split(hist, gain, min_rows)))
        if out:
            kinds = [pa.int32(), pa.binary(), *[pa.float64()] * 4, pa.int32(), pa.int32(), *[pa.float64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             _SPLIT_NAMES)
    parts = rows.frame.mapInArrow(partial, _PARTS)
    if before is not None:
        parts = parts.unionByName(before)
    most = int(rows.frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(min(most, len(wanted)), "node").mapInArrow(meet, _SPLITS)


def _chosen(root: Node, splits: dict[int, dict], depth: int | None, leaves: int | None, min_gain: float,
            level: dict[int, int]) -> list[Node]:
    """Nodes to split: all worth it down to ``depth``, or those that best-leaf-first growth with ``leaves`` leaves would split,
    of the nodes known so far."""
    def worth(node):
        return node.id in splits and splits[node.id]["gain"] > min_gain and (depth is None or level[node.id] < depth)
    if leaves is None:
        return [n for n in root.all() if worth(n)]
    heap, taken = [(-splits[root.id]["gain"], root.id, root)] if worth(root) else [], []
    while heap and len(taken) + 1 < leaves:
        node = heapq.heappop(heap)[2]
        taken.append(node)
        for child in (node.left, node.right):
            if child is not None and worth(child):
                heapq.heappush(heap, (-splits[child.id]["gain"], child.id, child))
    return taken


def _parents(held: Sequence[DataFrame], pairs: dict[int, tuple[int, int]]) -> DataFrame:
    """Stored histograms of the nodes that were split, under the numbers of their children."""
    every = held[0]
    for more in held[1:]:
        every = every.unionByName(more)
    small, large = (F.create_map(*[F.lit(x) for node, pair in pairs.items() for x in (node, pair[i])])[F.col("node")] for i in (0, 1))
    return every.select(small.cast("int").alias("node"), large.cast("int").alias("sibling"), F.lit(True).alias("whole"), "hist").where(
        F.col("node").isNotNull())


def grow_tree(rows: Rows | Block, columns: Sequence[int], gradient, gain, leaf_value, depth: int | None, min_rows: int = 1,
              max_leaves: int | None = None, min_gain: float = 1e-12, seed: int = 0, subsample: float = 1.0) -> Node:
    """Grow one tree on the sums of ``gradient(y, m)`` = (a, b), which decide gains and leaf values. One job per level, none on a ``Block``.

    With ``max_leaves`` splits are made as best-leaf-first growth makes them. A node's best split does not depend on the
    order of growth, so a round evaluates the children of all splits such a growth would make as far as it is known.
    """
    root = Node(0, 0.0)
    splits, level, nodes, held, before = {}, {0: 0}, {0: root}, [], None
    here, kept = isinstance(rows, Block), {}
    wanted = {0: (0, -1)}
    while wanted:
        if here:
            found, every = rows.level(Trunk.of(root), wanted, before, columns, gradient, gain, min_rows, seed, subsample)
            kept = {**kept, **found} if max_leaves is not None else found
        else:
            found = _level(rows, Trunk.of(root), wanted, before, columns, gradient, gain, min_rows, seed, subsample)
            if max_leaves is not None:  # each round reads all rounds before it, so their plans would double every round
                found = cut_lineage(found)
            elif depth is None or max(level.values()) + 1 < depth:  # else no node below needs the histograms
                found = found.persist(StorageLevel.MEMORY_AND_DISK)
            every = found.drop("hist").collect()  # one row per node
            if max_leaves is None:  # only the level just found is split next
                _give_back(held)
            held.append(found)
        for r in every:
            node = nodes[r["node"]]
            node.a, node.b, node.value = r["a"], r["b"], leaf_value(r["a"], r["b"])
            splits[node.id] = r
        fresh = [n for n in _chosen(root, splits, depth, max_leaves, min_gain, level) if n.left is None]
        pairs = {}
        for node in fresh:
            r = splits[node.id]
            node.gain, node.feature, node.bin = r["gain"], columns[r["feature"]], r["bin"]
            node.threshold = rows.edges[node.feature][node.bin + 1]
            la, lb = r["left_a"], r["left_b"]
            node.left = Node(len(nodes), leaf_value(la, lb), a=la, b=lb)
            node.right = Node(len(nodes) + 1, leaf_value(node.a - la, node.b - lb), a=node.a - la, b=node.b - lb)
            for child in (node.left, node.right):
                nodes[child.id], level[child.id] = child, level[node.id] + 1
            if depth is None or level[node.id] + 1 < depth:
                small, large = (node.left, node.right) if 2 * r["left_n"] <= r["n"] else (node.right, node.left)
                pairs[node.id] = (small.id, large.id)
        wanted = {small: (small, large) for small, large in pairs.values()}
        before = {small: kept[node] for node, (small, _) in pairs.items()} if here else _parents(held, pairs) if pairs else None
    _give_back(held)
    if max_leaves is not None:
        chosen = {n.id for n in _chosen(root, splits, depth, max_leaves, min_gain, level)}
        for node in list(root.all()):
            if node.left is not None and node.id not in chosen:
                node.left = node.right = None
    return root


def _give_back(held: list[DataFrame]) -> None:
    while held:
        held.pop().unpersist()


def _settle(frame: DataFrame) -> DataFrame:
    """Write the state of the loop out, so that neither its plan nor its history grows, and keep it at hand."""
    return cut_lineage(frame).persist(StorageLevel.MEMORY_AND_DISK)


def _depth(node: Node) -> int:
    return 0 if node.left is None else 1 + max(_depth(node.left), _depth(node.right))


@dataclass
class TreeEnsemble:
    """Weighted trees over named numeric columns. ``link`` maps the summed value to a probability."""

    features: list[str]
    base: float
    link: str  # "logit" (boosting) or "vote" (AdaBoost)
    trees: list[tuple[float, Node]] = field(default_factory=list)

    def _arrays(self):
        out = []
        for weight, root in self.trees:
            nodes = list(root.all())
            at = {id(n): i for i, n in enumerate(nodes)}
            split = [n.left is not None for n in nodes]
            out.append((weight,
                        np.array([n.feature if s else -1 for n, s in zip(nodes, split)]),
                        np.array([n.threshold for n in nodes]),
                        np.array([at[id(n.left)] if s else i for i, (n, s) in enumerate(zip(nodes, split))]),
                        np.array([at[id(n.right)] if s else i for i, (n, s) in enumerate(zip(nodes, split))]),
                        np.array([n.value for n in nodes]), _depth(root)))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``margin``, ``score`` (probability of class 1) and ``prediction``."""
        arrays, base = self._arrays(), self.base

        @F.pandas_udf("double")
        def summed(x: pd.Series) -> pd.Series:
            matrix = np.array(x.tolist(), dtype=float).reshape(len(x), -1)
            # as in the bins: a gap lies beyond every number, +inf just below a threshold of inf
            matrix = np.where(np.isnan(matrix), np.inf, np.minimum(matrix, np.finfo(float).max))
            total = np.full(len(matrix), base)
            rows = np.arange(len(matrix))
            for weight, feature, threshold, left, right, value, deep in arrays:
                at = np.zeros(len(matrix), dtype=int)
                for _ in range(deep):
                    f = feature[at]
                    go_left = matrix[rows, np.maximum(f, 0)] < threshold[at]
                    at = np.where(f < 0, at, np.where(go_left, left[at], right[at]))
                total += weight * value[at]
            return pd.Series(total)

        margin = summed(F.array(*[F.coalesce(as_column(c).cast("double"), F.lit(math.nan)) for c in self.features]))
        scored = df.withColumn("margin", margin)
        if self.link == "vote":
            mass = sum(w for w, _ in self.trees) or 1.0
            scored = scored.withColumn("margin", F.col("margin") * F.lit(2.0 / mass))
        return scored.withColumn("score", sigmoid("margin")).withColumn(
            "prediction", (F.col("margin") > 0).cast("double"))

    def feature_importance(self, spark_frame: DataFrame, kind: str = "gain") -> DataFrame:
        """Share of gain per feature, or with ``kind="splits"`` the number of splits."""
        totals = [0.0] * len(self.features)
        for weight, root in self.trees:
            mine = [0.0] * len(self.features)
            for node in root.all():
                if node.left is not None:
                    mine[node.feature] += node.gain if kind == "gain" else 1
            size = sum(mine) or 1.0
            for i, v in enumerate(mine):
                totals[i] += weight * v / size if self.link == "vote" and kind == "gain" else v
        if kind == "gain":
            total = sum(totals) or 1.0
            totals = [t / total for t in totals]
        return importance_table(spark_frame, totals, self.features)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        for t, (weight, root) in enumerate(self.trees):
            for n in root.all():
                split = n.left is not None
                rows.append((t, n.id, n.feature if split else -1, float(n.threshold), n.left.id if split else -1,
                             n.right.id if split else -1, float(n.value), float(n.gain), float(weight)))
        return small_frame(spark, rows, TREE_SCHEMA + ", weight double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Two small Parquet tables: the trees, and one row with the feature names."""
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        head = small_frame(spark, [(self.features, self.base, self.link)], "features array<string>, base double, link string")
        head.coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeEnsemble":
        head = spark.read.parquet(f"{path}/model").first()
        model = TreeEnsemble(list(head["features"]), head["base"], head["link"])
        per_tree: dict[int, dict[int, object]] = {}
        for r in spark.read.parquet(f"{path}/trees").collect():
            per_tree.setdefault(r["tree"], {})[r["node"]] = r

        def build(rows, i):
            r = rows[i]
            node = Node(i, r["value"], r["feature"], -1, r["threshold"], r["gain"])
            if r["left"] >= 0:
                node.left, node.right = build(rows, r["left"]), build(rows, r["right"])
            return node

        for t in sorted(per_tree):
            model.trees.append((per_tree[t][0]["weight"], build(per_tree[t], 0)))
        return model


def expand_vector(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """One double column per slot of a vector column."""
    from pyspark.ml.functions import vector_to_array
    frame = df.withColumn("_slots", vector_to_array(vector))
    return frame.withColumns({n: F.col("_slots")[i] for i, n in enumerate(names)}).drop("_slots")


def _settle(frame: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """Write the state of the loop out, so that neither its plan nor its history grows, and keep it at hand."""
    settled = cut_lineage(frame).persist(StorageLevel.MEMORY_AND_DISK)
    if old is not None:
        old.unpersist()
    return settled


def adaboost(train: DataFrame, label: str, features: Sequence[str], rounds: int = 150, rate: float = 0.8,
             depth: int = 1, max_bins: int = 64, checkpoint_every: int = 10) -> TreeEnsemble:
    """Discrete AdaBoost of Gini trees on a 0/1 label.

    A round with weighted error e gets the weight rate * ln((1 - e) / e); rows it gets wrong
    gain that much in log-weight. It stops at e = 0 or e >= 1/2. One job per tree level and round, one in all
    on a single block: the error follows from the sums of the leaves.
    """
    rows = Rows.of(train.where(as_column(label).isNotNull()), label, features, (), max_bins, 1.0)
    model = TreeEnsemble(list(features), 0.0, "vote", rows.boosted(rounds, _reweighed(len(features), rounds, rate, depth, checkpoint_every)))
    rows.close()
    return model


def _reweighed(width: int, rounds: int, rate: float, depth: int, checkpoint_every: int) -> Callable[[Rows | Block], list[tuple[float, Node]]]:
    """The rounds of ``adaboost``, on given rows."""
    def grow(rows: Rows | Block) -> list[tuple[float, Node]]:
        trees = []
        for r in range(1, rounds + 1):
            tree = grow_tree(rows, range(width), lambda y, w: (w * y, w), gini_gain, lambda a, b: 1.0 if b and a / b > 0.5 else -1.0, depth)
            rows.release()
            if not tree.b:
                break
            error = sum(n.b - n.a if n.value > 0 else n.a for n in tree.all() if n.left is None) / tree.b
            if error <= 1e-12:
                trees.append((1.0, tree))
                break
            if error >= 0.5:
                if not trees:
                    trees.append((1.0, tree))
                break
            alpha = rate * math.log((1 - error) / error)
            trees.append((alpha, tree))

            def reweigh(bins, y, w, trunk=Trunk.of(tree), scale=1.0 / tree.b, factor=math.exp(alpha)):
                wrong = (trunk.value[trunk.places(bins)] > 0) != (y == 1)
                return w * scale * np.where(wrong, factor, 1.0)
            if r < rounds:
                rows.move(reweigh, settle=r % checkpoint_every == 0)
        return trees

    return grow


def newton_boost(train: DataFrame, label: str, features: Sequence[str], ids: Sequence[str], trees: int = 200,
                 rate: float = 0.05, depth: int | None = None, subsample: float = 0.8, colsample: float = 0.8, lam: float = 1.0,
                 min_weight: float = 1.0, min_rows: int = 1, growth: str = "level", leaves: int = 31,
                 max_bins: int = 64, seed: int = 42, checkpoint_every: int = 10) -> TreeEnsemble:
    """Second-order boosting of the logistic loss on a 0/1 label.

    Each tree sees a fresh ``subsample`` of the rows (drawn by row hash) and ``colsample`` of
    the columns; a leaf's value is -sum(g) / (sum(h) + lam). Level-wise trees are ``depth`` (6) deep; ``growth="leaf"`` grows the
    ``leaves`` best leaves, at any depth unless one is given. One job per level, one in all on a single block.
    """
    labelled = train.where(as_column(label).isNotNull())
    share = labelled.agg(F.avg(as_column(label).cast("double")).alias("p")).first()["p"]
    share = min(max(share or 0.0, 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    rows = Rows.of(labelled, label, features, ids, max_bins, base)
    depth = 6 if depth is None and growth == "level" else depth
    take = max(1, round(colsample * len(features)))

    def gradient(y, margin):
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    def grow(rows: Rows | Block) -> list[tuple[float, Node]]:
        rng, grown = random.Random(seed), []
        for t in range(trees):
            columns = sorted(rng.sample(range(len(rows.edges)), take))
            tree = grow_tree(rows, columns, gradient, newton_gain(lam, min_weight), lambda g, h: -g / (h + lam) if h + lam > 0 else 0.0,
                             depth, min_rows, leaves if growth == "leaf" else None, seed=seed + t, subsample=subsample)
            rows.release()
            grown.append((rate, tree))

            def move(bins, y, margin, trunk=Trunk.of(tree)):
                return margin + rate * trunk.value[trunk.places(bins)]
            if t + 1 < trees:
                rows.move(move, settle=(t + 1) % checkpoint_every == 0)
        return grown

    model = TreeEnsemble(list(features), base, "logit", rows.boosted(trees, grow))
    rows.close()
    return model
