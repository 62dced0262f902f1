"""Random forests (and single Gini trees) grown level by level on all rows.

A vector's slots are cut into quantile bins once; the binned rows stay cached. All trees of a forest grow together: one job
per level (more where its histograms exceed ``CELLS``) routes every row through each tree, adds its bootstrap weight to the
histograms of its open node, and chooses the splits where the tasks' sums meet, so one row per node reaches the driver.
A node of at most ``LOCAL_ROWS`` rows leaves the levels: its rows meet in a task, which grows all that lies below it.
A row's weight in a tree is Poisson(1), drawn from its values and the tree's number: a recomputed task draws the same,
and rows with equal values and label share a draw. A node knows how many rows it holds, so ``min_split`` and ``min_leaf`` count rows.

Nodes are numbered as in a heap and draw their features by that number. So the first trees of a forest are those of a
smaller one, a forest cut at a depth is the one grown to that depth, and one whose smaller nodes are closed is the one grown
with that ``min_split`` (``Forest.cut``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import reused, small_frame

CELLS = 8_000_000  # histogram cells that a task holds at once (64 MB)
LOCAL_ROWS = 32_768  # a node of no more rows is grown to its end in one task
TASK_ROWS = 1_000_000  # rows of such nodes that a task holds, about
CHUNK_CELLS = 500_000  # histogram cells of their nodes at once
FRAME_ROWS = 250_000  # rows of a partition of the binned rows
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def _mixed(codes: np.ndarray, *salts: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit codes (multipliers of a published bit mixer)."""
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64)
        for salt in salts:
            x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) * 2.0**-53


def _bins(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of every slot; a gap lies beyond every number, in the last bin."""
    out = np.empty(x.shape, np.int16)
    for i, e in enumerate(edges):
        out[:, i] = np.where(np.isnan(x[:, i]), len(e), np.searchsorted(e, x[:, i], side="right"))
    return out


@dataclass
class Tree:
    """Nodes in order of their growth, the root first; a left child is followed by its right sibling."""

    heap: np.ndarray
    feature: np.ndarray  # -1 at a leaf
    bin: np.ndarray  # bins up to this one go left
    left: np.ndarray
    counts: np.ndarray  # weight per class
    rows: np.ndarray
    gain: np.ndarray

    @staticmethod
    def root(classes: int) -> "Tree":
        return Tree(np.zeros(1, np.int64), np.full(1, -1), np.zeros(1, int), np.zeros(1, int), np.zeros((1, classes)),
                    np.zeros(1, int), np.zeros(1))

    def depth(self) -> np.ndarray:
        return np.frexp((self.heap + 1).astype(float))[1] - 1

    def places(self, bins: np.ndarray, stops: Sequence[int] = (), min_split: int = 0) -> Iterator[np.ndarray]:
        """The node of each row at every depth of ``stops`` (ascending), or its leaf without stops; nodes with fewer than
        ``min_split`` rows count as leaves."""
        inner = (self.feature >= 0) & (self.rows >= min_split)
        # a leaf goes left to itself
        feature, left = np.where(inner, self.feature, 0), np.where(inner, self.left, np.arange(len(inner)))
        limit = np.where(inner, self.bin, np.iinfo(np.int64).max)
        cells, start, step = bins.ravel(), np.arange(len(bins)) * bins.shape[1], 0
        at, last = np.zeros(len(bins), np.int64), int(self.depth()[inner].max(initial=-1)) + 1
        for stop in stops or (last,):
            for _ in range(step, min(stop, last)):
                right = cells.take(start + feature.take(at)) > limit.take(at)
                at = left.take(at) + right
            step = max(step, min(stop, last))
            yield at

    def weights(self) -> np.ndarray:
        """Class shares of every node."""
        return self.counts / np.maximum(self.counts.sum(1, keepdims=True), 1e-300)


@dataclass
class Forest:
    """A fitted forest: adds ``probability`` (mean of the leaves' class shares, as a vector) and ``prediction``."""

    features: str
    classes: list[float]
    edges: list[np.ndarray]
    trees: list[Tree]

    def cut(self, trees: int | None = None, depth: int | None = None, min_split: int = 0) -> "Forest":
        """The forest of the first ``trees`` trees, none deeper than ``depth``, that splits no node of fewer than ``min_split`` rows."""
        kept = [replace(t, feature=np.where(t.rows < min_split, -1, t.feature)) for t in self.trees[:trees]]
        if depth is not None:
            kept = [replace(t, feature=np.where(t.depth() >= depth, -1, t.feature)) for t in kept]
        return replace(self, trees=kept)

    def shares(self, bins: np.ndarray) -> np.ndarray:
        total = np.zeros((len(bins), len(self.classes)))
        for tree in self.trees:
            at = next(tree.places(bins))
            total += tree.counts[at] / tree.counts[at].sum(1, keepdims=True)
        return total / len(self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        model = self  # a few numbers per node

        @F.pandas_udf("array<double>")
        def shares(x: pd.Series) -> pd.Series:
            matrix = np.array(x.tolist(), dtype=float).reshape(len(x), len(model.edges))
            return pd.Series(list(model.shares(_bins(matrix, model.edges))))

        scored = df.withColumn("_p", shares(vector_to_array(self.features)))
        best = F.array_position("_p", F.array_max("_p")).cast("int") - 1
        return scored.withColumn("probability", array_to_vector("_p")).withColumn(
            "prediction", F.get(F.array(*[F.lit(float(c)) for c in self.classes]), best)).drop("_p")

    def accuracies(self, df: DataFrame, label: str, cuts: Sequence[tuple[int, ...]]) -> list[float]:
        """Accuracy of every (trees, depth) or (trees, depth, min_split) cut of the forest, all in one reading of ``df``."""
        model, classes = df.sparkSession.sparkContext.broadcast(self), np.array(self.classes)
        cuts = [(*c, 0)[:3] for c in cuts]
        stops = {m: sorted({d for _, d, s in cuts if s == m}) for _, _, m in cuts}
        last = {(d, m): max(t for t, *c in cuts if c == [d, m]) for _, d, m in cuts}

        def count(batches):
            hits, n = np.zeros(len(cuts)), 0
            for pdf in batches:
                if pdf.empty:
                    continue
                edges = model.value.edges
                bins = _bins(np.array(pdf["x"].tolist(), dtype=float).reshape(len(pdf), len(edges)), edges)
                total = {end: np.zeros((len(pdf), len(classes))) for end in last}
                y = pdf["y"].to_numpy()
                n += len(pdf)
                for i, tree in enumerate(model.value.trees):
                    shares = tree.weights()
                    for m, depths in stops.items():
                        asked = [d for d in depths if last[d, m] > i]
                        for d, at in zip(asked, tree.places(bins, asked, m) if asked else ()):
                            total[d, m] += shares[at]
                    for c, (t, d, m) in enumerate(cuts):
                        if t == i + 1:
                            hits[c] += (classes[total[d, m].argmax(1)] == y).sum()
            yield pd.DataFrame({"cut": np.arange(len(cuts)), "hits": hits, "n": n})

        rows = df.select(vector_to_array(self.features).alias("x"), as_column(label).cast("double").alias("y"))
        rows = rows.repartition(df.sparkSession.sparkContext.defaultParallelism)  # a small table may lie in one partition
        found = rows.mapInPandas(count, "cut int, hits double, n long").groupBy("cut").agg(
            (F.sum("hits") / F.greatest(F.sum("n"), F.lit(1))).alias("a")).collect()  # one row per cut
        model.destroy()
        by = {r["cut"]: float(r["a"]) for r in found}
        return [by.get(c, 0.0) for c, _ in enumerate(cuts)]

    @property
    def featureImportances(self) -> np.ndarray:
        """Drop of impurity by feature: every tree's shares, averaged, as shares of 1."""
        total = np.zeros(len(self.edges))
        for tree in self.trees:
            own = np.bincount(tree.feature[tree.feature >= 0], tree.gain[tree.feature >= 0], len(self.edges))
            total += own / own.sum() if own.sum() else 0.0
        return total / total.sum() if total.sum() else total

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per node: (tree, node, feature, threshold, left, rows, counts); values below the threshold go left."""
        rows = []
        for i, t in enumerate(self.trees):
            for j, f in enumerate(t.feature):
                limit = float(self.edges[f][t.bin[j]]) if f >= 0 else None
                rows.append((i, j, int(f) if f >= 0 else None, limit, int(t.left[j]) if f >= 0 else None, int(t.rows[j]),
                             [float(c) for c in t.counts[j]]))
        return small_frame(spark, rows, "tree int, node int, feature int, threshold double, left int, rows long, counts array<double>")


def _edges(rows: DataFrame, width: int, max_bins: int) -> list[np.ndarray]:
    """At most ``max_bins - 1`` approximate quantiles per slot, none at the smallest value (nothing lies below it)."""
    shares = [i / max_bins for i in range(1, max_bins)]
    found = (rows.select(F.posexplode("x").alias("slot", "v")).where(~F.isnan("v")).groupBy("slot")
             .agg(F.percentile_approx("v", shares, 8 * max_bins).alias("e"), F.min("v").alias("low"), F.max("v").alias("high")).collect())
    out = [np.zeros(0) for _ in range(width)]  # one row per slot reaches the driver
    for r in found:
        out[r["slot"]] = np.array(sorted({e for e in [*r["e"], r["high"]] if e > r["low"]}))
    return out


def _draw(heaps: np.ndarray, numbers: np.ndarray, seed: int, width: int, count: int) -> np.ndarray:
    """The ``count`` slots, in order, that each node of a tree may split on."""
    order = np.column_stack([_mixed(heaps, seed, 1_000_003 + f, 7) for f in range(width)])
    order = (order + _mixed(numbers, seed, 11)[:, None] * (1 + np.arange(width))) % 1.0
    return np.sort(np.argsort(order, axis=1)[:, :count], axis=1)


def _weighted(code: np.ndarray, w: np.ndarray, seed: int, numbers: Sequence[int], asked: Sequence[int],
              bootstrap: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(tree, rows that it drew, their weights) of the trees ``asked``; trees of several forests that have one number share their draws."""
    weights: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i in asked:
        if numbers[i] not in weights:
            own = w * np.searchsorted(_POISSON, _mixed(code, seed, numbers[i]), side="right") if bootstrap else w
            drawn = np.flatnonzero(own > 0)
            weights[numbers[i]] = drawn, own[drawn]
        yield i, *weights[numbers[i]]


def _level(frame: DataFrame, trees: Sequence[Tree], numbers: Sequence[int], open_nodes: Sequence[tuple[int, int]], drawn: np.ndarray,
           classes: int, width: int, bins: int, bootstrap: bool, min_leaf: Sequence[int], seed: int) -> pd.DataFrame:
    """The best split of every open node, at least ``min_leaf[slot]`` rows on both sides: (slot, feature, bin, gain, left and whole sums per class, rows)."""
    cells = drawn.shape[1] * bins * (classes + 1)
    slots = [np.full(len(t.heap), -1) for t in trees]
    for slot, (tree, node) in enumerate(open_nodes):
        slots[tree][node] = slot
    asked = [i for i, s in enumerate(slots) if (s >= 0).any()]
    shape = (len(open_nodes), drawn.shape[1], bins, classes + 1)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(int(np.prod(shape)))
        for batch in batches:
            if not batch.num_rows:
                continue
            code, y, w = (batch.column(i).to_numpy() for i in range(3))
            x = batch.column(3).flatten().to_numpy().reshape(batch.num_rows, width)
            for i, rows, weight in _weighted(code, w, seed, numbers, asked, bootstrap):
                slot = slots[i][next(trees[i].places(x[rows]))]
                here = slot >= 0
                rows, weight, slot = rows[here], weight[here], slot[here]
                if not len(rows):
                    continue
                base = (slot[:, None] * shape[1] + np.arange(shape[1])) * bins + x[rows[:, None], drawn[slot]]
                low = base.min() * (classes + 1)
                for at, value in ((base * (classes + 1) + y[rows][:, None], weight), (base * (classes + 1) + classes, None)):
                    flat = (at - low).ravel()
                    got = np.bincount(flat, None if value is None else np.repeat(value, shape[1]))
                    sums[low:low + len(got)] += got
        sums = sums.reshape(len(open_nodes), cells)
        kept = np.nonzero(sums.any(1))[0]
        for start in range(0, len(kept), 1000):
            some = kept[start:start + 1000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(list(sums[some]), pa.list_(pa.float64()))],
                                             ["slot", "sums"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # the nodes of one partition, at most CELLS numbers
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, cells)
            for slot, row in zip(batch.column(0).to_numpy(), values):
                if slot in total:
                    total[slot] += row
                else:
                    total[slot] = row.copy()
        found = [(int(slot), *_best(h.reshape(shape[1:]), drawn[slot], min_leaf[slot])) for slot, h in total.items()]
        if found:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=names), schema=pa.schema(fields), preserve_index=False)

    names = ["slot", "feature", "bin", "gain", "lower", "whole", "lower_rows", "rows"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64(), pa.int64()]
    fields = list(zip(names, kinds))
    parts = frame.mapInArrow(partial, "slot int, sums array<double>")
    if len(open_nodes) > 1:
        parts = parts.repartition("slot")
    else:
        parts = parts.coalesce(1)
    return parts.mapInArrow(choose, "slot int, feature int, bin int, gain double, lower array<double>, whole array<double>, "
                                    "lower_rows long, rows long").toPandas()


def _purity(s: np.ndarray) -> np.ndarray:
    """Weight minus impurity, of sums per class with the rows last."""
    n = s[..., :-1].sum(-1)
    return np.divide((s[..., :-1]**2).sum(-1), n, out=np.zeros_like(n), where=n > 0)


def _splits(hist: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node (place among the drawn features, -1 without a split, bin, gain, left and whole sums): the largest drop of weighted
    Gini impurity over the drawn features' bins, the first feature and bin of equals."""
    nodes, whole = np.arange(len(hist)), hist[:, 0].sum(1)
    lower = hist.cumsum(2)[:, :, :-1]
    upper = whole[:, None, None] - lower
    gain = _purity(lower) + _purity(upper) - _purity(whole)[:, None, None]
    fine = (lower[..., -1] >= min_leaf) & (upper[..., -1] >= min_leaf)
    gain = np.where(fine, np.round(gain, 9), -1.0).reshape(len(hist), -1)
    if not gain.shape[1]:
        return np.full(len(hist), -1), nodes * 0, nodes * 0.0, whole, whole
    best = gain.argmax(1)
    f, b = np.divmod(best, lower.shape[2])
    most = gain[nodes, best]
    there = most > 0
    left = np.where(there[:, None], lower[nodes, f, b], whole)
    return np.where(there, f, -1), np.where(there, b, 0), np.where(there, most, 0.0), left, whole


def _best(hist: np.ndarray, features: np.ndarray, min_leaf: int):
    """``_splits`` of one node."""
    f, b, gain, lower, whole = (v[0] for v in _splits(hist[None], min_leaf))
    return (int(features[f]) if f >= 0 else -1, int(b), float(gain), lower[:-1].tolist(), whole[:-1].tolist(), int(round(lower[-1])),
            int(round(whole[-1])))


_NODES = "tree int, heap long, feature int, bin int, gain double, counts array<double>, rows long"


def _subtrees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, root: np.ndarray, tree: np.ndarray, heap: np.ndarray, numbers: np.ndarray,
              limits: Sequence[Limits], classes: int, bins: int, count: int, seed: int) -> Iterator[pa.RecordBatch]:
    """All nodes from the given roots on (tree and heap number of each), grown level by level; rows come ordered by ``root``."""
    def told(feature, bin_, gain, counts, rows):
        flat = pa.ListArray.from_arrays(np.arange(0, counts.size + 1, classes, dtype=np.int32), pa.array(counts.ravel()))
        return pa.RecordBatch.from_arrays(
            [pa.array(tree.astype(np.int32)), pa.array(heap), pa.array(feature.astype(np.int32)), pa.array(bin_.astype(np.int32)),
             pa.array(gain), flat, pa.array(np.round(rows).astype(np.int64))], ["tree", "heap", "feature", "bin", "gain", "counts", "rows"])

    deepest, split, leaf = (np.array([getattr(o, n) for o in limits]) for n in ("depth", "min_split", "min_leaf"))
    node, width = root, x.shape[1]
    wait = np.ones(len(tree), bool)
    while len(tree):
        f, b, gain = np.full(len(tree), -1), np.zeros(len(tree), int), np.zeros(len(tree))
        sums = np.column_stack([np.bincount(node, weight * (y == c), len(tree)) for c in range(classes)] + [np.bincount(node, minlength=len(tree))])
        left = sums.copy()
        asked = np.flatnonzero(wait)
        drawn = np.zeros((len(tree), count), int)
        if len(asked):
            drawn[asked] = _draw(heap[asked], numbers[tree[asked]], seed, width, count)
        step = max(1, CHUNK_CELLS // (count * bins * (classes + 1)))
        for low in range(0, len(asked), step):
            some = asked[low:low + step]
            first, last = np.searchsorted(node, [some[0], some[-1] + 1])  # rows are ordered by their node
            place = np.full(some[-1] + 1 - some[0], -1)
            place[some - some[0]] = np.arange(len(some))
            own = place[node[first:last] - some[0]]
            kept = np.flatnonzero(own >= 0)
            own, rows = own[kept], first + kept
            cell = (own[:, None] * count + np.arange(count)) * bins + x[rows[:, None], drawn[node[rows]]]
            hist = np.empty((len(some) * count * bins, classes + 1))
            for c in range(classes):
                hist[:, c] = np.bincount(cell.ravel(), np.repeat(weight[rows] * (y[rows] == c), count), len(hist))
            hist[:, classes] = np.bincount(cell.ravel(), minlength=len(hist))
            found = _splits(hist.reshape(len(some), count, bins, classes + 1), leaf[tree[some]][:, None, None])
            f[some], b[some], gain[some], left[some] = found[:4]
        level = np.frexp((heap + 1).astype(float))[1] - 1
        parted = (f >= 0) & (level < deepest[tree]) & (sums[:, -1] >= split[tree])
        feature = np.where(parted, drawn[np.arange(len(tree)), np.maximum(f, 0)], -1)
        yield told(feature, np.where(parted, b, 0), np.where(parted, gain, 0.0), sums[:, :-1], sums[:, -1])
        # rows of split nodes go on to the children, which stand in the order of their parents
        child = np.cumsum(parted) * 2 - 2
        going = np.flatnonzero(parted[node])
        here = node[going]
        node = child[here] + (x[going, feature[here]] > b[here])
        order = np.argsort(node, kind="stable")
        going, node = going[order], node[order]
        x, y, weight = x[going], y[going], weight[going]
        below = np.stack([left[parted], sums[parted] - left[parted]], 1).reshape(-1, classes + 1)
        tree = np.repeat(tree[parted], 2)
        heap = (2 * heap[parted][:, None] + np.array([1, 2])).ravel()
        wait = ((np.repeat(level[parted], 2) + 1 < deepest[tree]) & (below[:, -1] >= np.maximum(split, 2 * leaf)[tree])
                & ((below[:, :-1] > 1e-9).sum(1) > 1))


def _finish(frame: DataFrame, trees: list[Tree], numbers: Sequence[int], small: Sequence[tuple[int, int]], held: int, limits: Sequence[Limits],
            classes: int, width: int, bins: int, count: int, bootstrap: bool, seed: int) -> None:
    """Grow all that lies below the nodes ``small``, whose rows (``held`` in all) meet in tasks, and put it into ``trees``."""
    slots = [np.full(len(t.heap), -1) for t in trees]
    for slot, (tree, node) in enumerate(small):
        slots[tree][node] = slot
    asked = sorted({tree for tree, _ in small})
    kind = np.uint8 if bins <= 256 else np.int16
    grown = [trees[i] if i in set(asked) else None for i, _ in enumerate(trees)]
    top = np.array([trees[t].heap[n] for t, n in small])
    owner = np.array([t for t, _ in small])
    spark = frame.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-held // TASK_ROWS))

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, y, w = (batch.column(i).to_numpy() for i in range(3))
            x = batch.column(3).flatten().to_numpy().reshape(batch.num_rows, width)
            out = []
            for i, rows, weight in _weighted(code, w, seed, numbers, asked, bootstrap):
                slot = slots[i][next(grown[i].places(x[rows]))]
                order = np.argsort(slot, kind="stable")
                order = order[np.searchsorted(slot[order], 0):]
                slot, rows, weight = slot[order], rows[order], weight[order]
                first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else slot
                for a, b in zip(first, np.r_[first[1:], len(slot)]):
                    r = rows[a:b]
                    out.append((int(slot[a]), x[r].astype(kind).tobytes(), y[r].astype(np.int16).tobytes(), weight[a:b].astype(float).tobytes()))
                if len(out) >= 1000:
                    yield packed(out)
                    out = []
            if out:
                yield packed(out)

    def packed(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                          ["slot", "x", "y", "w"])

    number = np.array(numbers)

    def grow_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for slot, *cells in zip(*(c.to_pylist() for c in batch.columns)):
                parts.setdefault(slot, []).append(cells)
        some, n = [], 0
        for slot in sorted(parts):
            some.append(slot)
            n += sum(len(c[1]) // 2 for c in parts[slot])
            if n > LOCAL_ROWS or len(some) == len(parts):
                yield from whole(some, parts)
                some, n = [], 0
        if some:
            yield from whole(some, parts)

    def whole(some: list[int], parts: dict[int, list]) -> Iterator[pa.RecordBatch]:
        got = [parts.pop(slot) for slot in some]
        x, y, w = (np.frombuffer(b"".join(c[i] for cells in got for c in cells), t) for i, t in enumerate((kind, np.int16, float)))
        root = np.repeat(np.arange(len(some)), [sum(len(c[1]) // 2 for c in cells) for cells in got])
        yield from _subtrees(x.reshape(-1, width), y, w, root, owner[some], top[some], number, limits, classes, bins, count, seed)

    found = (frame.mapInArrow(parted, "slot int, x binary, y binary, w binary").repartition(tasks, "slot")
             .mapInArrow(grow_all, _NODES).toArrow())  # the nodes of the trees
    if not found.num_rows:
        return
    tree, heap, feature, bin_, gain, rows = (found.column(c).to_numpy() for c in ("tree", "heap", "feature", "bin", "gain", "rows"))
    counts = found.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, classes)
    order = np.lexsort((heap, tree))
    ends = np.searchsorted(tree[order], [asked, [i + 1 for i in asked]])
    for i, low, high in zip(asked, *ends):
        own, t = order[low:high], trees[i]
        old = ~np.isin(t.heap, heap[own])
        parts = [np.concatenate([a[old], b[own]]) for a, b in ((t.heap, heap), (t.feature, feature), (t.bin, bin_), (t.counts, counts),
                                                               (t.rows, rows), (t.gain, gain))]
        # a left child stands just before its right sibling, as heap numbers do
        sort = np.argsort(parts[0], kind="stable")
        heaps, features, cut, sums, n, drop = (a[sort] for a in parts)
        left = np.where(features >= 0, np.searchsorted(heaps, 2 * heaps + 1), 0)
        trees[i] = Tree(heaps, features.astype(int), cut.astype(int), left, sums, n, drop)


@dataclass(frozen=True)
class Limits:
    """Size of a forest; ``min_split`` and ``min_leaf`` count rows."""

    trees: int = 200
    depth: int = 15
    min_split: int = 2
    min_leaf: int = 1

    def of_tree(self, number: int, cuts: Sequence[tuple[int, int, int]]) -> "Limits":
        """What the cuts that have more than ``number`` trees need of that tree."""
        asked = [c for c in cuts if c[0] > number] or [(0, 0, self.min_split)]
        return replace(self, depth=min(self.depth, max(c[1] for c in asked)), min_split=max(self.min_split, min(c[2] for c in asked)))


def grow(train: DataFrame, label: str, features: str = "features", trees: int = 200, depth: int = 15, min_split: int = 2,
         min_leaf: int = 1, **options) -> Forest:
    """Grow one forest; see ``grow_many``."""
    return grow_many(train, label, [Limits(trees, depth, min_split, min_leaf)], features, **options)[0]


def grow_many(train: DataFrame, label: str, limits: Sequence[Limits], features: str = "features", max_bins: int = 64,
              subset: int | None = None, bootstrap: bool = True, weight: str | None = None, seed: int = 42,
              cuts: Sequence[Sequence[tuple[int, int, int]]] | None = None) -> list[Forest]:
    """Grow Gini forests of several limits together, each node on ``subset`` drawn slots (default: the rounded-down root of the width).

    ``cuts`` names the (trees, depth, min_split) cuts of each forest that will be asked for: then a tree is grown only as far as
    the cuts need that count it in.

    A node with fewer than ``min_split`` rows stays a leaf, and no child has fewer than ``min_leaf``. Every forest is the one
    that a call of its own would grow. Rows without a label or vector, or with a weight that is not positive, take no part;
    gaps in a vector lie beyond every number. Without rows it is an error.
    """
    y, w = as_column(label).cast("double"), as_column(weight).cast("double") if weight else F.lit(1.0)
    plain = train.where(y.isNotNull() & as_column(features).isNotNull() & (w > 0)).select(
        vector_to_array(features).alias("x"), y.alias("y"), w.alias("w"))
    found = plain.groupBy("y").agg(F.max(F.size("x")).alias("d"), F.count("*").alias("n")).collect()  # one row per class
    if not found:
        raise ValueError("no labelled rows")
    labels, width = {r["y"] for r in found}, max(r["d"] for r in found)
    classes = sorted(labels | {0.0, 1.0} if labels <= {0.0, 1.0} else labels)  # a binary label keeps both its classes
    edges = _edges(plain, width, max_bins)
    bins = max(len(e) for e in edges) + 1
    count, seed = max(1, min(width, subset or int(math.sqrt(width)))), seed % 2**31

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            short = pa.ListArray.from_arrays(np.arange(0, x.size + 1, width, dtype=np.int32), pa.array(_bins(x, edges).ravel()))
            place = np.searchsorted(classes, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place.astype(np.int32)), batch.column(3), short], ["code", "y", "w", "x"])

    coded = plain.select(F.xxhash64("x", "y", F.lit(seed)).alias("code"), "x", "y", "w")
    rows = sum(r["n"] for r in found)
    coded = coded.repartition(max(train.sparkSession.sparkContext.defaultParallelism, -(-rows // FRAME_ROWS)))
    owner = [(f, i) for f, limit in enumerate(limits) for i in range(limit.trees)]
    own, numbers = [limits[f] if cuts is None else limits[f].of_tree(i, cuts[f]) for f, i in owner], [i for _, i in owner]
    forest = [Tree.root(len(classes)) for _ in owner]
    fits = max(1, CELLS // (count * bins * (len(classes) + 1)))
    with reused(coded.mapInArrow(binned, "code long, y int, w double, x array<smallint>")) as frame:
        waiting, small, held = [(i, 0) for i, _ in enumerate(owner)], [], 0
        for t in forest:
            t.rows[0] = rows
        for step in range(max(1, max(limit.depth for limit in limits))):
            fit = [e for e in waiting if forest[e[0]].rows[e[1]] <= LOCAL_ROWS]
            small += fit
            held += sum(int(forest[t].rows[n]) for t, n in fit)
            waiting = [e for e in waiting if forest[e[0]].rows[e[1]] > LOCAL_ROWS]
            if not waiting:
                break
            grown = []
            for start in range(0, len(waiting), fits):
                some = waiting[start:start + fits]
                drawn = _draw(np.array([forest[t].heap[n] for t, n in some]), np.array([numbers[t] for t, _ in some]), seed, width, count)
                found = _level(frame, forest, numbers, some, drawn, len(classes), width, bins, bootstrap,
                               [own[t].min_leaf for t, _ in some], seed)
                grown += [(some[r.slot], r) for r in found.itertuples()]
            waiting = _extend(forest, grown, own, step)
        if small:
            _finish(frame, forest, numbers, small, held, own, len(classes), width, bins, count, bootstrap, seed)
    # a tree that drew no row at all has nothing to say
    return [Forest(features, classes, edges, [t for t, (g, _) in zip(forest, owner) if g == f and t.counts[0].sum() > 0])
            for f, _ in enumerate(limits)]


def _extend(forest: list[Tree], grown: list, limits: Sequence[Limits], step: int) -> list[tuple[int, int]]:
    """Write the sums of the level's nodes, split those that may be, and list the children that are worth a look."""
    waiting, by_tree = [], {}
    for (tree, node), r in grown:
        by_tree.setdefault(tree, []).append((node, r))
    for i, nodes in by_tree.items():
        t, new, limit = forest[i], [], limits[i]
        for node, r in sorted(nodes, key=lambda e: e[0]):
            whole, lower = np.array(r.whole), np.array(r.lower)
            t.counts[node], t.rows[node] = whole, r.rows
            if step >= limit.depth or r.feature < 0 or r.rows < limit.min_split:
                continue
            t.feature[node], t.bin[node], t.gain[node], t.left[node] = r.feature, r.bin, r.gain, len(t.heap) + len(new)
            for side, (sums, rows) in enumerate(((lower, r.lower_rows), (whole - lower, r.rows - r.lower_rows))):
                if step + 1 < limit.depth and rows >= max(limit.min_split, 2 * limit.min_leaf) and np.count_nonzero(sums > 1e-9) > 1:
                    waiting.append((i, len(t.heap) + len(new)))
                new.append((2 * t.heap[node] + 1 + side, sums, rows))
        if new:
            heap, sums, rows = zip(*new)
            more = len(new)
            forest[i] = Tree(np.append(t.heap, heap), np.append(t.feature, np.full(more, -1)), np.append(t.bin, np.zeros(more, int)),
                             np.append(t.left, np.zeros(more, int)), np.vstack([t.counts, sums]), np.append(t.rows, rows), np.append(t.gain, np.zeros(more)))
    return sorted(waiting)
