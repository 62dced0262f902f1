"""Nearest neighbours by collision counting over sorted projections.

Each block of rows keeps PROJECTIONS arrays, one per random direction, of its vectors' projections in order. Around a
query's own projections windows open in all arrays at once, by virtual rehashing: their half-width is a radius that grows
by GROWTH each round, and only what a round adds is read. A vector that collides in at least COLLISIONS of the arrays is verified
by its distance; a query ends once its k-th nearest verified vector lies within the radius, or all vectors are verified.

A vector at the radius collides in an array with chance 0.683, so it is missed with a chance of about 9e-4, a nearer one with less; a query's k
nearest of all blocks together are mostly nearer than its k-th in each. Equal vectors of a block are one class that
keeps its k + 1 smallest ids: more of a class can't be among the k nearest.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows without an id. Of rows that share an
id the first by vector takes part. Vectors of different lengths are not compared. Ties go to the smaller id.
No rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulith.runtime import write_out

from .tiles import by_length, column_matrix, finite, map_groups, ranked, tiled

PROJECTIONS = 32
COLLISIONS = 14
GROWTH = 1.2
ROUNDS = 300  # the last verifies all, for vectors too far apart for a radius
TOGETHER = 128  # queries whose windows grow together
START = 64  # rows whose nearest sets a query's first radius, at a quarter of the distance


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, each summed component by component, so that equal vectors have equal ones."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        step = rows[:, j] - query[j]
        total += step * step
    return np.sqrt(total)


class Projections:
    """Sorted projections of a block's distinct vectors."""

    def __init__(self, vectors: np.ndarray, seed: int = 17):
        self.vectors = vectors
        n, width = vectors.shape
        self.square = (vectors * vectors).sum(1)
        self.directions = np.random.default_rng(seed).normal(size=(width, PROJECTIONS))
        values = np.ascontiguousarray((vectors @ self.directions).T)
        order = np.argsort(values, axis=1, kind="stable")
        self.values = np.take_along_axis(values, order, 1)
        self.flat = order.ravel()
        self.base = np.arange(PROJECTIONS) * n

    def members(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Vectors in the stretches from ``low`` up to ``high`` of the arrays, with repeats."""
        n = high - low
        ends = np.cumsum(n)
        places = np.repeat(low - (ends - n), n)
        places += np.arange(int(ends[-1]))
        return self.flat[places]

    def nearest(self, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, vectors, distances) of vectors verified for each query, among them its ``k`` nearest but for rare misses."""
        n, ways = len(self.vectors), len(queries)
        centre = queries @ self.directions
        sample = self.vectors[np.linspace(0, n - 1, min(n, START)).astype(np.int64)]
        radius = np.empty(ways)
        for q in range(ways):
            far = distances(sample, queries[q])
            radius[q] = max(far.max() / 1024, far.min() / 4, 1e-9 * (1 + np.abs(centre[q]).max()))
        count, seen = np.zeros((ways, n), np.int32), np.zeros((ways, n), bool)
        squares = np.full((ways, n), np.inf)
        low = np.stack([np.searchsorted(v, centre[:, j]) for j, v in enumerate(self.values)])
        high = low.copy()
        active = np.arange(ways)
        for turn in range(ROUNDS):
            reach = radius[active] + 1e-9 * (1 + np.abs(centre[active]).max(1))
            going = []
            for j, v in enumerate(self.values):
                at = centre[active, j]
                ends = np.searchsorted(v, np.concatenate([at - reach, at + reach]))
                going.append((ends[:len(active)], ends[len(active):]))
            wider = np.minimum(np.array([g[0] for g in going]), low[:, active]), np.maximum(np.array([g[1] for g in going]), high[:, active])
            for i, q in enumerate(active.tolist()):
                met = self.members(np.concatenate([wider[0][:, i] + self.base, high[:, q] + self.base]),
                                   np.concatenate([low[:, q] + self.base, wider[1][:, i] + self.base]))
                count[q] += np.bincount(met, minlength=n).astype(np.int32)
                fresh = np.flatnonzero((count[q] >= (COLLISIONS if turn < ROUNDS - 1 else 0)) & ~seen[q])
                seen[q, fresh] = True
                step = self.vectors[fresh] - queries[q]
                squares[q, fresh] = np.einsum("rd,rd->r", step, step)
            low[:, active], high[:, active] = wider
            kth = np.sqrt(np.partition(squares[active], min(k, n) - 1, axis=1)[:, min(k, n) - 1])
            done = (kth <= radius[active]) | seen[active].all(1)
            for q, bound in zip(active[done].tolist(), kth[done].tolist()):
                # the distances that count are summed anew, in one order for all
                near = np.flatnonzero(seen[q] & (squares[q] <= bound * bound * (1 + 1e-9)))
                yield q, near, distances(self.vectors[near], queries[q])
            active = active[~done]
            if not len(active):
                return
            radius[active] *= GROWTH


def _first_of_each(keys: np.ndarray) -> np.ndarray:
    """Places of the first row of each key, of rows sorted by key."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def _searched(k: int):
    def search(rows: pa.Table, queries: pa.Table) -> Iterator[pa.RecordBatch]:
        for mine, asking in by_length(rows, queries, "v"):
            keys, vectors = mine.column("key").to_numpy(), column_matrix(mine.column("v")) + 0.0
            first = _first_of_each(keys)
            keys, vectors = keys[first], vectors[first]
            _, place, group = np.unique(np.ascontiguousarray(vectors).view(f"V{vectors.shape[1] * 8}").ravel(),
                                        return_index=True, return_inverse=True)
            order = np.lexsort((keys, group))
            start = np.searchsorted(group[order], np.arange(len(place)))
            within = np.arange(len(order)) - start[group[order]]
            order = order[within <= k]  # one of them may be the query itself
            start = np.searchsorted(group[order], np.arange(len(place) + 1))
            block = Projections(vectors[place])
            ids, centres = asking.column("key").to_numpy(), column_matrix(asking.column("v")) + 0.0
            first = _first_of_each(ids)
            ids, centres = ids[first], centres[first]
            found = ([], [], [])
            answers = chain.from_iterable(((low + q, c, far) for q, c, far in block.nearest(centres[low:low + TOGETHER], k + 1))
                                          for low in range(0, len(ids), TOGETHER))
            for at, classes, far in answers:
                n = start[classes + 1] - start[classes]
                rows_of = np.repeat(start[classes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                other, far = keys[order[rows_of]], np.repeat(far, n)
                other, far = other[(real := other != ids[at])], far[real]
                best = np.lexsort((other, far))[:k]
                found[0].append(np.full(len(best), ids[at]))
                found[1].append(other[best])
                found[2].append(far[best])
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(f)) for f in found], ["query_id", "vec_id", "score"])
    return search


def nearest(rows: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of each row that ``asks`` holds for, by Euclidean distance."""
    usable = finite("v") & F.exists("v", lambda x: x != 0) & F.col("key").isNotNull()
    own = write_out(rows.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("v"),
                                F.coalesce(asks, F.lit(False)).alias("asks")).where(usable), "search-vectors")
    tiles = tiled(own.select("key", "v"), own.where("asks").select("key", "v"), "key")
    found = map_groups(tiles, _searched(k), "query_id bigint, vec_id bigint, score double")
    return ranked(found, ["query_id"], [F.col("score"), F.col("vec_id")], k).select("query_id", "rank", "vec_id", "score")
