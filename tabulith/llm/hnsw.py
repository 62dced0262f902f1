"""Near-duplicate embeddings by navigable small-world graphs, one per shard.

Vectors are compared within their label only. Equal vectors are one class with a multiplicity. A label's classes
are dealt by a hash into shards of bounded size; each shard gets a layered small-world graph, and every class
of the label queries every shard of it. A query's beam widens until its worst member falls below the
threshold, and all beams of a shard widen until an audit against brute force finds the wanted share of the true
links. Every link is decided by the double-precision cosine. Links within and between shards are joined
into components.

Vectors that are null, zero, or hold a null or non-finite component, and rows without a label, link with nothing.
Repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.operators.clustering import connected_components
from tabulith.runtime import write_out

from .words import bound_batches

SHARD_ROWS = 8192
DEGREE = 12  # links of a node per layer; twice as many at the bottom
BUILD_BEAM = 48
QUERY_BEAM = 48
QUERY_ROWS = 1024
AUDIT_ROWS = 64
RECALL = 0.99  # share of the audited rows' true links that a shard's search must find


class Graph:
    """A layered small-world graph of unit vectors, built and searched for many vectors at a time."""

    def __init__(self, vectors: np.ndarray, seed: int = 1):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        draw = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(DEGREE)).astype(np.int64), 6)
        self.links = [np.full((n, DEGREE * (2 if layer == 0 else 1)), -1, np.int64)
                      for layer in range(int(self.level.max(initial=0)) + 1)]
        self.order = np.argsort(-self.level, kind="stable")  # upper layers first, so that each batch can descend
        self.entry = int(self.order[0]) if n else -1
        done = min(n, 1)
        while done < n:
            batch = self.order[done:done + max(1, min(done, 512))]
            self._insert(batch, done)
            done += len(batch)

    def _insert(self, batch: np.ndarray, done: int) -> None:
        near = np.full(len(batch), self.entry)
        level = self.level[batch]
        for layer in range(len(self.links) - 1, -1, -1):
            near_ids, near_sims = self.search_layer(self.vectors[batch], near, layer, BUILD_BEAM if (level >= layer).any() else 1)
            near = np.where(near_ids[:, 0] >= 0, near_ids[:, 0], near)
            mine = np.flatnonzero(level >= layer)
            if not len(mine):
                continue
            own = batch[mine]
            sims = self.vectors[own] @ self.vectors[own].T
            np.fill_diagonal(sims, -2)
            k = min(BUILD_BEAM, len(own))
            close = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            ids = np.hstack([near_ids[mine], own[close]])
            sims = np.hstack([near_sims[mine], np.take_along_axis(sims, close, 1)])
            ids = np.where(sims > -1.5, ids, -1)
            chosen = self._select(ids, sims, DEGREE)
            self.links[layer][own, :DEGREE] = chosen
            self._link_back(own, chosen, layer)

    def _select(self, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
        """Per row, near nodes that are nearer to the row than to one chosen before; free places take the nearest left."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, :3 * degree]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        vectors = self.vectors[np.maximum(ids, 0)]
        between = np.einsum("rid,rjd->rij", vectors, vectors)
        rows, width = ids.shape
        taken = np.zeros((rows, width), bool)
        count = np.zeros(rows, np.int64)
        for j in range(width):
            blocked = (taken[:, :j] & (between[:, j, :j] > sims[:, j:j + 1])).any(1)
            repeat = (taken[:, :j] & (ids[:, :j] == ids[:, j:j + 1])).any(1)
            take = (ids[:, j] >= 0) & ~blocked & ~repeat & (count < degree)
            taken[:, j] = take
            count += take
        for j in range(width):
            repeat = (taken & (ids == ids[:, j:j + 1])).any(1)
            take = (ids[:, j] >= 0) & ~taken[:, j] & ~repeat & (count < degree)
            taken[:, j] |= take
            count += take
        place = np.argsort(~taken, axis=1, kind="stable")[:, :degree]
        out = np.where(np.take_along_axis(taken, place, 1), np.take_along_axis(ids, place, 1), -1)
        return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)

    def _link_back(self, own: np.ndarray, chosen: np.ndarray, layer: int) -> None:
        links = self.links[layer]
        source = np.repeat(own, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, n = np.unique(target, return_index=True, return_counts=True)
        width = links.shape[1]
        new = np.full((len(nodes), int(n.max(initial=0))), -1, np.int64)
        new[np.repeat(np.arange(len(nodes)), n), np.arange(len(target)) - np.repeat(first, n)] = source
        ids = np.hstack([links[nodes], new])
        for part in np.array_split(np.arange(len(nodes)), len(nodes) // 512 + 1):
            if len(part):
                sims = np.einsum("rd,rid->ri", self.vectors[nodes[part]], self.vectors[np.maximum(ids[part], 0)])
                sims = np.where((ids[part] >= 0) & (ids[part] != nodes[part, None]), sims, -2)
                links[nodes[part]] = self._select(np.where(sims > -1.5, ids[part], -1), sims, width)

    def search_layer(self, queries: np.ndarray, start: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of up to ``beam`` near nodes per query, nearest first; -1 fills up.

        All queries advance together: each round opens every query's best unopened members.
        """
        rows = len(queries)
        links = self.links[layer]
        seen = np.zeros((rows, len(self.vectors)), bool)
        ids = np.full((rows, beam), -1, np.int64)
        sims = np.full((rows, beam), -2.0, np.float32)
        opened = np.zeros((rows, beam), bool)
        ids[:, 0] = start
        sims[:, 0] = np.einsum("rd,rd->r", queries, self.vectors[start])
        seen[np.arange(rows), start] = True
        active = np.arange(rows)
        width = 1 if beam == 1 else max(1, min(4, beam // 16))
        while len(active):
            wait = np.where(opened[active] | (ids[active] < 0), -3.0, sims[active])
            best = np.argsort(-wait, axis=1, kind="stable")[:, :width]
            real = np.take_along_axis(wait, best, 1) > -2.5
            some = real.any(1)
            active, best, real = active[some], best[some], real[some]
            if not len(active):
                break
            opened[active[:, None], best] |= real
            node = np.where(real, np.take_along_axis(ids[active], best, 1), -1)
            reach = np.where(node[:, :, None] >= 0, links[np.maximum(node, 0)], -1).reshape(len(active), -1)
            known = seen[active[:, None], np.maximum(reach, 0)] | (reach < 0)
            seen[active[:, None], np.maximum(reach, 0)] |= reach >= 0
            reach = np.where(known, -1, reach)
            if reach.shape[1] > links.shape[1]:  # one round may reach a node twice
                order = np.sort(reach, axis=1)
                order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
                reach = order
            near = np.einsum("rd,rid->ri", queries[active], self.vectors[np.maximum(reach, 0)])
            near = np.where(reach >= 0, near, -2.0).astype(np.float32)
            all_ids = np.hstack([ids[active], reach])
            all_sims = np.hstack([sims[active], near])
            all_open = np.hstack([opened[active], np.zeros(reach.shape, bool)])
            keep = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active] = np.take_along_axis(all_ids, keep, 1)
            sims[active] = np.take_along_axis(all_sims, keep, 1)
            opened[active] = np.take_along_axis(all_open, keep, 1)
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        near = np.full(len(queries), self.entry)
        for layer in range(len(self.links) - 1, 0, -1):
            near = self.search_layer(queries, near, layer, 1)[0][:, 0]
        return self.search_layer(queries, near, 0, beam)

    def within(self, queries: np.ndarray, threshold: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query rows, node ids) of all pairs found at or above the threshold; full beams are searched again, wider."""
        rows, n = np.arange(len(queries)), len(self.vectors)
        while len(rows):
            beam = min(beam, n)
            full = []
            step = max(1, min(256, (1 << 19) // beam, (1 << 24) // n))
            for low in range(0, len(rows), step):
                part = rows[low:low + step]
                ids, sims = self.search(queries[part], beam)
                narrow = (ids[:, -1] >= 0) & (sims[:, -1] >= threshold) & (beam < n)
                full.append(part[narrow])
                good = (sims >= threshold) & (ids >= 0) & ~narrow[:, None]
                r, c = np.nonzero(good)
                yield part[r], ids[r, c]
            rows = np.concatenate(full)
            beam *= 4


class Shard:
    """One shard's classes and their graph, with the beam that its audit asked for."""

    def __init__(self, reps: np.ndarray, copies: np.ndarray, vectors: np.ndarray, threshold: float):
        self.reps, self.copies, self.exact, self.threshold = reps, copies, vectors, threshold
        self.graph = Graph(vectors)
        self.recall, self.beam = 1.0, QUERY_BEAM
        audit = np.linspace(0, len(reps) - 1, min(AUDIT_ROWS, len(reps))).astype(np.int64)
        truth = vectors[audit] @ vectors.T >= threshold
        while True:
            found = np.zeros_like(truth)
            for r, c in self.graph.within(self.graph.vectors[audit], threshold - 1e-4, self.beam):
                found[r, c] = True
            self.recall = float((found & truth).sum() / max(1, truth.sum()))
            if self.recall >= RECALL or self.beam >= len(reps):
                break
            self.beam *= 2

    def links(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query rows, members) whose double-precision cosine reaches the threshold."""
        for r, c in self.graph.within(np.ascontiguousarray(vectors, np.float32), self.threshold - 1e-4, self.beam):
            good = np.einsum("rd,rd->r", vectors[r], self.exact[c]) >= self.threshold
            yield r[good], c[good]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _searches(dealt: DataFrame, threshold: float) -> DataFrame:
    """(rep, other, links): a class's links into a shard, counted with their copies, in a row where other is the class
    itself; and the links that connect a block of queries with the shard as all of them would."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, shard, members = None, None, []
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part, (label, at, query) = batch.slice(a, b - a), keys[a]
                if (label, at) != place:
                    place, shard, members = (label, at), None, []
                if not query:
                    members.append(part)
                    continue
                if shard is None:
                    own = pa.Table.from_batches(members).combine_chunks()
                    shard = Shard(own.column(3).to_numpy(), own.column(4).to_numpy(),
                                  _unit(_matrix(own.column(5).chunk(0))), threshold)
                yield from _found(shard, part)

    bound_batches(dealt.sparkSession)
    grouped = dealt.repartition("label", "shard").sortWithinPartitions("label", "shard", "query", "rep")
    return grouped.mapInArrow(rows, "rep bigint, other bigint, links bigint")


def _found(shard: Shard, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    reps = part.column(3).to_numpy()
    vectors = _unit(_matrix(part.column(5)))
    for low in range(0, len(reps), QUERY_ROWS):
        own = reps[low:low + QUERY_ROWS]
        linked = np.zeros((len(own), len(shard.reps)), bool)
        for r, c in shard.links(vectors[low:low + QUERY_ROWS]):
            linked[r, c] = True
        linked &= own[:, None] != shard.reps[None, :]
        src, dst = _spanning(linked)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([own, own[src]])),
             pa.array(np.concatenate([own, shard.reps[dst]])),
             pa.array(np.concatenate([linked @ shard.copies, np.zeros(len(src), np.int64)]))], ["rep", "other", "links"])


def _spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (row, column) of a spanning forest of a block's links."""
    rows, columns = linked.any(1), np.ones(linked.shape[1], bool)
    src, dst = [], []
    while rows.any():
        front = np.flatnonzero(rows)[:1]
        rows[front] = False
        while len(front):
            reach = linked[front] & columns
            met = np.flatnonzero(reach.any(0))
            if not len(met):
                break
            columns[met] = False
            src.append(front[reach[:, met].argmax(0)])
            dst.append(met)
            back = linked[:, met] & rows[:, None]
            front = np.flatnonzero(back.any(1))
            rows[front] = False
            src.append(front)
            dst.append(met[back[front].argmax(1)] if len(front) else front)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *src]), np.concatenate([none, *dst])


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.93, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(key, n_links, component_id) of each row: links are other rows of the same label with a cosine of at least
    ``threshold``; a component is named by its smallest key."""
    own = rows.select(F.col(key).cast("bigint").alias("key"), F.col(label).cast("string").alias("label"),
                      F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("key").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # vectors of another length than most cannot be compared; each length is a group of its own
    own = own.withColumn("label", F.when(usable, F.concat_ws("/", "label", F.size("v").cast("string")))).withColumn(
        "h", F.when(usable, F.xxhash64("v")))
    classes = own.where(F.col("h").isNotNull()).groupBy("label", "h", "v").agg(
        F.min("key").alias("rep"), F.count("*").alias("copies"))
    classes = write_out(classes, "vector-classes")
    sizes = classes.groupBy("label").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    placed = classes.join(F.broadcast(sizes), "label")
    home = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("shards")).cast("int")
    member = placed.select("label", home.alias("shard"), F.lit(0).alias("query"), "rep", "copies", "v")
    query = placed.select("label", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                          F.lit(1).alias("query"), "rep", "copies", "v")
    found = write_out(_searches(member.unionByName(query), threshold), "vector-links")
    pairs = found.where("rep <> other").select(F.col("rep").alias("src"), F.col("other").alias("dst")).distinct()
    ends = pairs.select(F.col("src").alias("node")).union(pairs.select("dst")).distinct()
    groups = connected_components(ends, pairs)
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = (classes.drop("v").join(totals, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
             .select("label", "h", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("component", "rep").alias("component_id")))
    out = own.select("key", "label", "h").join(named, ["label", "h"], "left")
    return out.select(F.col("key").alias(key),
                      F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
                      F.coalesce("component_id", "key").alias("component_id"))
