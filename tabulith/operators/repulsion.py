"""Sums over all rows of a force between positions, by a tree of space cells.

Space is halved along every axis; cells carry their row count and centre of mass. A row meets
a cell as one body at the coarsest level at which the two are not adjacent, so it meets a
bounded number of bodies per level and every other row exactly once. Levels are worked off in
tiers: a tier's cell, with the cells around it, has a bounded number of cells below it, and only
rows whose surroundings hold more rows than a task compares one by one go on to the next tier.

Up to ``HELD_ROWS`` rows a layout's positions are held by the driver and sent to the tasks of one job a round, each of
which walks the same cells down for its share of the rows (``Held``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage

TIER_BITS = 12     # a tier's cell has 2^12 cells below it, in any number of dimensions
TOTAL_BITS = 24    # halvings per axis; rows closer than 2^-24 of the layout's width act as one body
BLOCK_ROWS = 8192  # rows of one cell that a task works on; more are dealt to several blocks
CHUNK_ROWS = 2048  # rows per numpy step
LEAF_ROWS = 4096   # up to here the rows around a cell are met one by one, without further tiers
DIRECT_PAIRS = 1 << 17  # up to here a task's rows meet all finest cells of a tier at once, without coarser ones
RING = {1: 2, 2: 2, 3: 1}  # cells up to this many steps apart are adjacent; a wider ring is more exact
HELD_ROWS = 1 << 20  # up to here positions are held by the driver (24 MB in three dimensions)
NEAR_ROWS = 512      # rows around a cell that are met one by one where positions are held
HELD_PAIRS = 1 << 17  # pairs per numpy step there

# (gaps k x d, squared distances k) to (force vectors k x d, kernel values k)
Force = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def student_force(gap: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kernel = 1.0 / (1.0 + square)
    return gap * (kernel * kernel)[:, None], kernel


def fuzzy_force(a: float, b: float, clip: float = 4.0) -> Force:
    """Repulsion under the curve 1 / (1 + a d^(2b)); each component of a pair is clipped."""
    def force(gap, square):
        safe = np.maximum(square, 1e-12)
        size = np.where(square > 0, 2.0 * b / ((0.001 + square) * (1.0 + a * safe**b)), 0.0)
        return np.clip(gap * size[:, None], -clip, clip), np.ones(len(gap))

    return force


def _halved(grid: np.ndarray, dims: int) -> np.ndarray:
    lead = grid.ndim - dims
    return grid.reshape(grid.shape[:lead] + (grid.shape[-1] // 2, 2) * dims).sum(
        axis=tuple(lead + 1 + 2 * i for i in range(dims)))


class _Surroundings:
    """A tier's cell and those around it, as dense grids of row counts and coordinate sums per level."""

    def __init__(self, at: np.ndarray, count: np.ndarray, total: np.ndarray, mixed: np.ndarray, bits: int):
        self.dims, self.bits, self.ring = at.shape[1], bits, RING[at.shape[1]]
        width = 2 * self.ring + 1
        shape = (width << bits,) * self.dims
        where = tuple(at.T)
        counts, totals = np.zeros(shape), np.zeros((self.dims, *shape))
        counts[where] = count
        totals[(slice(None), *where)] = total.T
        self.mixed = np.zeros(shape, bool)
        self.mixed[where] = mixed
        self.levels = [(counts, totals)]
        for _ in range(bits - 1):
            self.levels.append(tuple(_halved(g, self.dims) for g in self.levels[-1]))
        self.levels.reverse()  # level 1 first, the finest last
        self.distant = np.array(list(product(range(2 * width), repeat=self.dims)))
        self.adjacent = np.array(list(product(range(-self.ring, self.ring + 1), repeat=self.dims)))

    def _meet(self, y, cells, met, level, force, own=None):
        """Sums of force and kernel of each row against the given cells; ``own`` leaves the row itself out of its cell."""
        counts, totals = self.levels[level - 1]
        flat = np.ravel_multi_index(tuple(np.moveaxis(cells, 2, 0)), counts.shape)
        n = np.where(met, counts.ravel()[flat], 0.0)
        total = totals.reshape(self.dims, -1)
        if own is not None:
            n = n - own
        row, col = np.nonzero(n > 0.5)
        weight = n[row, col]
        sums = total[:, flat[row, col]].T
        if own is not None:
            sums = sums - y[row] * own[col][:, None]
        gap = y[row] - sums / weight[:, None]
        vector, kernel = force(gap, (gap**2).sum(1))
        pushed = [np.bincount(row, vector[:, i] * weight, len(y)) for i in range(self.dims)]
        return np.stack(pushed, 1), np.bincount(row, kernel * weight, len(y))

    def act_on(self, y: np.ndarray, at: np.ndarray, force: Force, last: bool):
        """(forces, kernel sums, open) of rows at finest cells ``at``; open rows still lack their adjacent cells."""
        f, z, unresolved = np.zeros_like(y), np.zeros(len(y)), np.zeros(len(y), bool)
        own = (self.adjacent == 0).all(1).astype(float)
        for lo in range(0, len(y), CHUNK_ROWS):
            part = slice(lo, lo + CHUNK_ROWS)
            rows, here = y[part], at[part]
            for level in range(1, self.bits + 1):
                cell = here >> (self.bits - level)
                cells = 2 * ((cell >> 1) - self.ring)[:, None, :] + self.distant
                apart = (np.abs(cells - cell[:, None, :]) > self.ring).any(2)
                df, dz = self._meet(rows, cells, apart, level, force)
                f[part] += df
                z[part] += dz
            cells = here[:, None, :] + self.adjacent
            left = np.zeros(len(rows), bool)
            if not last:
                left = self.mixed[tuple(np.moveaxis(cells, 2, 0))].any(1)
            done = ~left
            df, dz = self._meet(rows[done], cells[done], True, self.bits, force, own)
            f[part][done] += df
            z[part][done] += dz
            unresolved[part] = left
        return f, z, unresolved


def _direct(y, at, spots, count, total, mixed, force: Force, last: bool):
    """As ``_Surroundings.act_on``, every row against every finest cell, some rows at a time."""
    dims, rows = y.shape[1], max(1, DIRECT_PAIRS // max(len(spots), 1))
    f, z, unresolved = np.zeros_like(y), np.zeros(len(y)), np.zeros(len(y), bool)
    for lo in range(0, len(y), rows):
        part = slice(lo, lo + rows)
        here = y[part]
        steps = np.abs(at[part, None, :] - spots[None, :, :]).max(2)
        near, own = steps <= RING[dims], (steps == 0).astype(float)
        left = np.zeros(len(here), bool) if last else (near & mixed[None, :]).any(1)
        n = np.where(near & left[:, None], 0.0, count[None, :] - own)
        row, col = np.nonzero(n > 0.5)
        weight = n[row, col]
        gap = here[row] - (total[col] - here[row] * own[row, col][:, None]) / weight[:, None]
        vector, kernel = force(gap, (gap**2).sum(1))
        f[part] = np.stack([np.bincount(row, vector[:, i] * weight, len(here)) for i in range(dims)], 1)
        z[part] = np.bincount(row, kernel * weight, len(here))
        unresolved[part] = left
    return f, z, unresolved


def _cell(axis: int, bits: int) -> Column:
    return F.shiftright(F.col(f"q{axis}"), TOTAL_BITS - bits)


def _summaries(placed: DataFrame, dims: int, bits: int) -> DataFrame:
    """One row per occupied cell: coordinates s0.., rows n, coordinate sums, and whether its rows differ in position."""
    axes = range(dims)
    y = [F.col("y")[i] for i in axes]
    mixed = F.lit(False)
    for i in axes:
        mixed = mixed | (F.max(y[i]) > F.min(y[i]))
    return placed.groupBy(*[_cell(i, bits).alias(f"s{i}") for i in axes]).agg(
        F.count("*").alias("n"), F.array(*[F.sum(v) for v in y]).alias("total"), mixed.alias("mixed"))


@dataclass
class Held:
    """Positions of all rows, one after the other, as sent to the tasks of a round, and the attraction along an edge.

    ``pull(weight, square)`` is what the gap of an edge's ends is multiplied by.
    """

    y: Broadcast
    pull: Callable[[np.ndarray, np.ndarray], np.ndarray]


def _pair_sums(rows: np.ndarray, bodies: np.ndarray, weight: np.ndarray, force: Force) -> tuple[np.ndarray, np.ndarray]:
    """Force and kernel sums of ``rows`` from all ``bodies``, themselves included where they are among them."""
    dims, most = rows.shape[1], max(1, HELD_PAIRS // max(len(bodies), 1))
    f, z = np.empty_like(rows), np.empty(len(rows))
    for lo in range(0, len(rows), most):
        some = rows[lo:lo + most]
        gap = (some.T[:, :, None] - bodies.T[:, None, :]).reshape(dims, -1)  # one axis after the other
        vector, kernel = force(gap.T, np.einsum("ij,ij->j", gap, gap))
        f[lo:lo + most] = np.stack([vector[:, i].reshape(len(some), -1) @ weight for i in range(dims)], 1)
        z[lo:lo + most] = kernel.reshape(len(some), -1) @ weight
    return f, z


class Cells:
    """Rows in the order of their space cells; cells of every size are runs of them."""

    def __init__(self, y: np.ndarray):
        self.dims = y.shape[1]
        low = y.min(0)
        width = float((y.max(0) - low).max()) or 1.0
        at = np.minimum(((y - low) / width * (1 << TOTAL_BITS)).astype(np.int64), (1 << TOTAL_BITS) - 1)
        # axes' bits in turn where they fit a number; three axes leave the lowest ones out
        self.bits = min(TOTAL_BITS, 62 // self.dims)
        at >>= TOTAL_BITS - self.bits
        code = np.zeros(len(y), np.int64)
        for bit in range(self.bits):
            for i in range(self.dims):
                code |= ((at[:, i] >> bit) & 1) << (bit * self.dims + i)
        self.order = np.argsort(code, kind="stable")
        self.code, self.y = code[self.order], y[self.order]
        self.summed = np.concatenate([np.zeros((1, self.dims)), (self.y - self.y.mean(0)).cumsum(0)])
        self.mean = self.y.mean(0)
        self.inside = np.array(list(product((0, 1), repeat=self.dims)))[:, ::-1]  # a cell's parts, in order

    def bodies(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centres of mass and row counts of runs."""
        n = high - low
        return self.mean + (self.summed[high] - self.summed[low]) / n[:, None], n.astype(float)

    def forces(self, first: int, last: int, force: Force) -> tuple[np.ndarray, np.ndarray]:
        """Force and kernel sums of the rows from ``first`` to ``last`` in the order of cells, from all others."""
        f, z = np.zeros((last - first, self.dims)), np.zeros(last - first)
        itself = float(force(np.zeros((1, self.dims)), np.zeros(1))[1][0])  # the kernel of a row with itself
        start = (np.zeros(1, np.int64), np.zeros((1, self.dims), np.int64), np.zeros(1, np.int64), np.full(1, len(self.y)))
        # a cell, the cells adjacent to it (prefix, place, run) and the bodies that it met at coarser levels
        waiting = [(0, 0, 0, len(self.y), start, (np.zeros((0, self.dims)), np.zeros(0)))]
        while waiting:
            level, own, low, high, near, met = waiting.pop()
            low, high = max(low, first), min(high, last)
            if low >= high:
                continue
            rows, part = self.y[low:high], slice(low - first, high - first)
            if (near[3] - near[2]).sum() <= NEAR_ROWS:
                around = np.concatenate([self.y[a:b] for a, b in zip(near[2], near[3])])
                df, dz = _pair_sums(rows, np.concatenate([met[0], around]), np.concatenate([met[1], np.ones(len(around))]), force)
                f[part], z[part] = df, dz - itself
            elif level == self.bits:  # rows too close to be told apart
                other = near[0] != own
                place, n = self.bodies(near[2][other], near[3][other])
                df, dz = _pair_sums(rows, np.concatenate([met[0], place]), np.concatenate([met[1], n]), force)
                place, n = (v[0] for v in self.bodies(near[2][~other], near[3][~other]))
                if n > 1:
                    gap = rows - (place * n - rows) / (n - 1)
                    vector, kernel = force(gap, (gap**2).sum(1))
                    df, dz = df + vector * (n - 1), dz + kernel * (n - 1)
                f[part], z[part] = df, dz
            else:
                waiting += self._parts(level + 1, own, near, met)
        return f, z

    def _parts(self, level: int, parent: int, near, met) -> list[tuple]:
        """The occupied parts of a cell, each with what is adjacent to it and what it has met."""
        prefix = ((near[0] << self.dims)[:, None] + np.arange(1 << self.dims)).ravel()
        place = (2 * near[1][:, None, :] + self.inside).reshape(-1, self.dims)
        shift = (self.bits - level) * self.dims
        low, high = np.searchsorted(self.code, prefix << shift), np.searchsorted(self.code, (prefix + 1) << shift)
        there = high > low
        prefix, place, low, high = prefix[there], place[there], low[there], high[there]
        com, n = self.bodies(low, high)
        out = []
        for i in np.flatnonzero(prefix >> self.dims == parent):
            close = np.abs(place - place[i]).max(1) <= RING[self.dims]
            far = ~close
            out.append((level, int(prefix[i]), int(low[i]), int(high[i]), (prefix[close], place[close], low[close], high[close]),
                        (np.concatenate([met[0], com[far]]), np.concatenate([met[1], n[far]]))))
        return out


def _held_forces(blocks: DataFrame, dims: int, force: Force, held: Held) -> DataFrame:
    """(rows, f, z, first, pull) of every block as binary numbers: repulsion of its share of the rows in the order of cells, which
    ``rows`` lists, and attraction of its own rows, from ``first`` on."""
    names = ["rows", "f", "z", "first", "pull"]
    kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, cells = held.y.value, None
        for batch in batches:
            for block, total, first, last, ends, other, weight in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = len(y) * block // total, len(y) * (block + 1) // total
                if len(y) <= LEAF_ROWS:
                    f, z = _pair_sums(y[a:b], y, np.ones(len(y)), force)
                    rows, z = np.arange(a, b), z - float(force(np.zeros((1, dims)), np.zeros(1))[1][0])
                else:
                    cells = cells or Cells(y)
                    rows, (f, z) = cells.order[a:b], cells.forces(a, b, force)
                # a block without edges has none of the three
                ends = np.frombuffer(ends, np.int64) if ends else np.zeros(last - first, np.int64)
                row = np.repeat(np.arange(last - first), np.diff(ends, prepend=0))
                gap = y[first:last][row].T - y[np.frombuffer(other or b"", np.int32)].T
                drawn = gap * held.pull(np.frombuffer(weight or b""), np.einsum("ij,ij->j", gap, gap))
                pulled = np.stack([np.bincount(row, drawn[i], last - first) for i in range(dims)], 1)
                cols = [[rows.astype(np.int64).tobytes()], [f.tobytes()], [z.tobytes()], [first], [pulled.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return blocks.mapInArrow(work, "rows binary, f binary, z binary, first long, pull binary")


def summed_forces(positions: DataFrame, dims: int, force: Force, held: Held | None = None) -> DataFrame:
    """Sum of ``force`` on every row from all other rows: (id, y, f, z), z being the sum of its kernel.

    With ``held`` the positions are there, and ``positions`` has blocks of edges (``manifold.edge_blocks``); the result has
    the sums of each as binary numbers.

    ``positions`` has (id, y array<double>) and should be stored, as it is read once per tier. Rows at
    one position exert no force on each other but count in z. Null positions and ids are not expected.
    What reaches the driver: the range of each axis, at most 4096 cells of the first tier, one flag per tier.
    """
    if held is not None:
        return _held_forces(positions, dims, force, held)
    axes, step, direct = range(dims), TIER_BITS // dims, DIRECT_PAIRS
    box = positions.agg(F.count("*").alias("n"), *[F.min(F.col("y")[i]).alias(f"lo{i}") for i in axes],
                        *[F.max(F.col("y")[i]).alias(f"hi{i}") for i in axes]).first()
    if not box["n"]:
        return positions.select("id", "y", F.col("y").alias("f"), F.lit(0.0).alias("z"))
    names = [f"q{i}" for i in axes]
    schema = (f"id {positions.schema['id'].dataType.simpleString()}, y array<double>, f array<double>, z double, "
              "open boolean, " + ", ".join(f"{q} long" for q in names))
    width = max(box[f"hi{i}"] - box[f"lo{i}"] for i in axes) or 1.0

    def coordinate(i):
        share = (F.col("y")[i] - F.lit(box[f"lo{i}"])) / F.lit(width)
        return F.least(F.floor(share * float(1 << TOTAL_BITS)), F.lit((1 << TOTAL_BITS) - 1)).cast("long").alias(f"q{i}")

    placed = positions.select("id", "y", *[coordinate(i) for i in axes])

    def bodies_of(cells, corner):
        return (cells[[f"s{i}" for i in axes]].to_numpy(np.int64) - corner, cells["n"].to_numpy(float),
                np.array(cells["total"].tolist()), cells["mixed"].to_numpy(bool))

    def answer(pdf, cells, corner, bits, grids):
        """Rows of ``pdf`` with the bodies of one tier added to (f, z); ``grids`` makes their dense form, or is None."""
        y = np.array(pdf["y"].tolist())
        at = (pdf[names].to_numpy() >> (TOTAL_BITS - bits)) - corner
        last = bits + step > TOTAL_BITS
        if grids is None or len(y) * len(cells[0]) <= direct:
            f, z, left = _direct(y, at, *cells, force, last)
        else:
            f, z, left = grids().act_on(y, at, force, last)
        if "f" in pdf:
            f, z = f + np.array(pdf["f"].tolist()), z + pdf["z"].to_numpy()
        return pd.DataFrame({"id": pdf["id"].to_numpy(), "y": list(y), "f": list(f), "z": z, "open": left,
                             **{q: pdf[q].to_numpy() for q in names}})

    few = box["n"] <= LEAF_ROWS
    start = TOTAL_BITS if few else step
    top = _summaries(placed, dims, start).toPandas()  # at most LEAF_ROWS or 2^TIER_BITS rows
    rim = np.full(dims, -(RING[dims] << start), np.int64)  # the first tier's cell is all of space, nothing lies around it

    def first_tier(batches):
        cells = bodies_of(top, rim)
        grids = None if few else cache(lambda: _Surroundings(*cells, step))
        for pdf in batches:
            if len(pdf):
                yield answer(pdf, cells, rim, start, grids)

    def tier(bits):
        def work(key, rows, cells):
            if rows.empty:
                return pd.DataFrame({c: [] for c in ("id", "y", "f", "z", "open", *names)})
            finest = TOTAL_BITS if key[-1] else bits
            corner = (np.array(key[:dims], np.int64) - RING[dims]) << (finest - bits + step)
            around = bodies_of(cells, corner)
            return answer(rows, around, corner, finest, None if key[-1] else lambda: _Surroundings(*around, step))

        return work

    current = cut_lineage(placed.mapInPandas(first_tier, schema))
    if few:
        return current.select("id", "y", "f", "z")
    settled = [current.where(~F.col("open"))]
    home, other = [f"h{i}" for i in axes], [f"g{i}" for i in axes]
    for bits in range(2 * step, TOTAL_BITS + 1, step):
        waiting = current.where("open")
        if waiting.isEmpty():
            break
        waiting = waiting.drop("open").select("*", *[_cell(i, bits - step).alias(h) for i, h in enumerate(home)])
        sizes = waiting.groupBy(*home).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
        offsets = F.array(*[F.struct(*[F.lit(o).alias(g) for g, o in zip(other, offset)])
                            for offset in product(range(-RING[dims], RING[dims] + 1), repeat=dims)])
        around = sizes.select("*", F.explode(offsets).alias("o")).select(
            *home, "blocks", *[(F.col(h) + F.col(f"o.{g}")).alias(g) for h, g in zip(home, other)])
        held = placed.groupBy(*[_cell(i, bits - step).alias(g) for i, g in enumerate(other)]).agg(F.count("*").alias("held"))
        # whether a cell with those around it is met row by row
        light = around.join(held, other).groupBy(*home).agg((F.sum("held") <= LEAF_ROWS).alias("light"))
        light = cut_lineage(sizes.join(light, home))
        around = around.drop("blocks").join(light, home)

        def bodies(finest, wanted):
            cells = _summaries(placed, dims, finest).select(
                "*", *[F.shiftright(f"s{i}", finest - bits + step).alias(g) for i, g in enumerate(other)])
            return cells.join(around.where(wanted), other).select(
                "n", "total", "mixed", *[f"s{i}" for i in axes], *home, "light",
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

        targets = waiting.join(light, home).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks")
        met = bodies(bits, ~F.col("light")).unionByName(bodies(TOTAL_BITS, F.col("light")))
        met = met.toDF(*met.columns)  # new names for the columns that both sides take from `light`
        keys = [*home, "block", "light"]
        current = cut_lineage(targets.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInPandas(tier(bits), schema))
        settled.append(current.where(~F.col("open")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select("id", "y", "f", "z")
