"""Hard negatives by rotated one-bit codes with deterministic intervals.

Vectors are integers: each component x becomes floor(256 x). A vector is rotated and coded by the signs of its coordinates; its
alignment with the code is stored, and what the code leaves over is coded again, LEVELS times in all, so that
vector = sum of alignment * code + residual. A query is laid out in PLANES bit planes, and its product with a code is a
weighted sum of popcounts. By Cauchy and Schwarz the true product differs from the estimate by at most |residual| |query| plus
|estimated vector| |what the planes leave over|, for every vector and without chance. Candidates whose interval can't reach the answer
are dropped, level by level; the others are scored in integers, so results are exact.

An anchor's positives are its first rows of the same label by score; for each positive the first rows of other labels with a score
between a share of the positive's and the positive's own are its negatives. Ties go to the smaller id.

Rows without an id or label, with a null or empty vector, or with a null or non-finite component take no part; neither do vectors whose
integer squares sum to 2^62 or more, whose products might not fit a long. Of rows that share an id the first by label, then
vector, takes part. Vectors of different lengths are not compared. No rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulith.runtime import write_out

from .tiles import by_length, column_matrix, finite, map_groups, ranked, tiled
from .words import bound_batches

LEVELS = 6
PLANES = 8
LARGEST = 2.0**62  # bound of a vector's sum of squares: products fit a long
SCALE = 256


def rotation(width: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(23).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    n, width = bits.shape
    whole = np.zeros((n, -(-width // 64) * 64), bool)
    whole[:, :width] = bits
    return np.ascontiguousarray(np.packbits(whole, axis=1)).view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes: vector x level x word, alignments: vector x level, lengths of what is left over: vector x level)."""
    left = vectors @ rotation(vectors.shape[1])
    root = np.sqrt(vectors.shape[1])
    codes, alignment, length = [], [], []
    for _ in range(LEVELS):
        sign = left >= 0
        along = np.abs(left).sum(1) / root
        left = left - along[:, None] / root * np.where(sign, 1.0, -1.0)
        codes.append(_packed(sign))
        alignment.append(along)
        length.append(np.sqrt((left * left).sum(1)))
    return np.stack(codes, 1), np.stack(alignment, 1), np.stack(length, 1)


class Asked:
    """Anchors as bit planes: rotated coordinates = low + step * sum of 2^b plane_b, but for a rest of known length."""

    def __init__(self, vectors: np.ndarray):
        turned = vectors @ rotation(vectors.shape[1])
        self.width = vectors.shape[1]
        self.low = turned.min(1)
        self.step = np.maximum((turned.max(1) - self.low) / (2**PLANES - 1), 1e-300)
        level = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, 2**PLANES - 1).astype(np.int64)
        rest = turned - (self.low[:, None] + self.step[:, None] * level)
        self.rest = np.sqrt((rest * rest).sum(1))
        self.total = self.low * self.width + self.step * level.sum(1)
        self.planes = np.stack([_packed(level >> b & 1 == 1) for b in range(PLANES)], 1)
        self.length = np.sqrt((vectors * vectors).sum(1))

    def product(self, a: int, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Products of anchor ``a`` with codes of one level, by popcounts; ``ones`` counts each code's bits."""
        high = np.zeros(len(codes), np.int64)
        for b in range(PLANES):
            shared = np.bitwise_count(codes & self.planes[a, b])
            high += (shared[:, 0] if codes.shape[1] == 1 else shared.sum(1)).astype(np.int64) << b
        return (2 * (self.low[a] * ones + self.step[a] * high) - self.total[a]) / np.sqrt(self.width)


class Block:
    """Coded rows of one block; an anchor's candidates are narrowed level by level."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, codes: np.ndarray, alignment: np.ndarray, length: np.ndarray,
                 whole: np.ndarray):
        self.keys, self.labels, self.whole = keys, labels, whole
        self.codes, self.alignment, self.length = codes, alignment, length
        self.ones = np.bitwise_count(codes).sum(2).astype(np.int64)
        self.span = np.cumsum(alignment, 1)  # no less than the length of the coded sum
        self.exact_in_double = float(np.abs(whole).max(initial=0)) ** 2 * whole.shape[1] < 2**52

    def intervals(self, asked: Asked, a: int, rows: np.ndarray, narrow) -> np.ndarray:
        """Rows left after all levels; ``narrow(low, high)`` says which to keep."""
        guess = np.zeros(len(rows))
        for level in range(LEVELS):
            guess = guess + self.alignment[rows, level] * asked.product(a, self.codes[rows, level], self.ones[rows, level])
            reach = (self.length[rows, level] * asked.length[a] + self.span[rows, level] * asked.rest[a]
                     + 1e-9 * asked.length[a] * (self.span[rows, level] + self.length[rows, level]))
            kept = narrow(guess - reach, guess + reach)
            rows, guess = rows[kept], guess[kept]
        return rows

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Integer products."""
        if self.exact_in_double and float(np.abs(anchor).max(initial=0)) ** 2 * len(anchor) < 2**52:
            return np.rint(self.whole[rows].astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
        return (self.whole[rows] * anchor).sum(1)


def _best(keys: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((keys, -scores))[:k]


def _at_least(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Which may be among the k largest: no fewer than k others surely exceed the rest."""
    if len(low) <= k:
        return np.ones(len(low), bool)
    return high >= np.partition(low, len(low) - k)[len(low) - k]


def _rows(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(first place of each key, keys, integer vectors)"""
    keys = table.column("key").to_numpy()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return first, keys[first], column_matrix(table.column("v"), np.int64)[first]


def _block(table: pa.Table, names: dict) -> Block:
    first, keys, whole = _rows(table)
    labels = np.array([names.setdefault(x, len(names)) for x in table.column("label").to_pylist()])[first]
    n = len(table)
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint64).reshape(n, LEVELS, -1)[first]
    return Block(keys, labels, codes, column_matrix(table.column("alignment"))[first], column_matrix(table.column("rest"))[first], whole)


def _positives(k: int):
    def search(rows: pa.Table, queries: pa.Table) -> Iterator[pa.RecordBatch]:
        names: dict = {}
        for mine, asking in by_length(rows, queries, "v"):
            block = _block(mine, names)
            first, ids, anchors = _rows(asking)
            labels = [names.get(asking.column("label")[i].as_py(), -1) for i in first.tolist()]
            asked = Asked(anchors.astype(np.float64))
            out = ([], [], [])
            own = {c: np.flatnonzero(block.labels == c) for c in set(labels)}
            for a, label in enumerate(labels):
                alike = own[label]
                left = block.intervals(asked, a, alike[block.keys[alike] != ids[a]], lambda low, high: _at_least(low, high, k))
                score = block.scores(left, anchors[a])
                best = _best(block.keys[left], score, k)
                out[0].append(np.full(len(best), ids[a]))
                out[1].append(block.keys[left][best])
                out[2].append(score[best])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out],
                                                 ["anchor_id", "positive_id", "positive_score"])
    return search


def _negatives(k: int, share: tuple[int, int]):
    top, bottom = share

    def search(rows: pa.Table, queries: pa.Table) -> Iterator[pa.RecordBatch]:
        names: dict = {}
        for mine, asking in by_length(rows, queries, "v"):
            block = _block(mine, names)
            first, ids, anchors = _rows(asking)
            asked = Asked(anchors.astype(np.float64))
            out = ([], [], [], [], [])
            for a, at in enumerate(first.tolist()):
                label = names.get(asking.column("label")[at].as_py(), -1)
                goals = asking.column("goals")[at].as_py()
                others = np.flatnonzero(block.labels != label)

                def narrow(low, high):
                    kept = np.zeros(len(low), bool)
                    for _, score in goals:
                        floor = top * score / bottom
                        may = (high >= floor) & (low <= score)
                        sure = low[(low >= floor) & (high <= score)]
                        if len(sure) >= k:
                            may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
                        kept |= may
                    return kept
                left = block.intervals(asked, a, others, narrow)
                score = block.scores(left, anchors[a])
                for positive, goal in goals:
                    fits = np.flatnonzero((top * goal <= bottom * score) & (score <= goal))
                    best = fits[_best(block.keys[left[fits]], score[fits], k)]
                    for x, value in zip(out, (ids[a], positive, block.keys[left[best]], goal, score[best])):
                        x.append(np.broadcast_to(value, len(best)))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out],
                                                 ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])
    return search


def _coded(rows: DataFrame) -> DataFrame:
    """Add codes, alignments and the lengths of what each level leaves over."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = np.diff(batch.column(2).offsets.to_numpy())
            for n in np.unique(width).tolist():
                part = batch.filter(pa.array(width == n))
                codes, along, left = encode(column_matrix(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(list(along), pa.list_(pa.float64())),
                     pa.array(list(left), pa.list_(pa.float64()))], [*part.schema.names, "codes", "alignment", "rest"])
    bound_batches(rows.sparkSession)
    return rows.mapInArrow(code, "key bigint, label string, v array<bigint>, asks boolean, codes binary, alignment array<double>, "
                                 "rest array<double>")


def hard_negatives(rows: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                   positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each row that ``asks`` holds for: its
    first ``positives`` rows of the same label, and for each the first ``negatives`` rows of other labels whose score is between
    ``share`` of the positive's and the positive's own."""
    own = rows.select(F.col(key).cast("bigint").alias("key"), F.col(label).cast("string").alias("label"),
                      F.col(vector).cast("array<double>").alias("f"), F.coalesce(asks, F.lit(False)).alias("asks"))
    square = F.aggregate("f", F.lit(0.0), lambda a, x: a + (F.abs(x * SCALE) + 1) * (F.abs(x * SCALE) + 1))
    own = own.where(F.col("key").isNotNull() & F.col("label").isNotNull() & finite("f") & (square < LARGEST)).select(
        "key", "label", F.transform("f", lambda x: F.floor(x * SCALE).cast("bigint")).alias("v"), "asks")
    coded = write_out(_coded(own), "residual-codes")
    columns = ["key", "label", "v", "codes", "alignment", "rest"]
    tiles = tiled(coded.select(columns), coded.where("asks").select(columns), "key")
    first = map_groups(tiles, _positives(positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    first = ranked(first, ["anchor_id"], [F.desc("positive_score"), F.col("positive_id")], positives)
    goals = first.groupBy(F.col("anchor_id").alias("key")).agg(  # at most ``positives`` per anchor
        F.collect_list(F.array("positive_id", "positive_score")).alias("goals"))
    anchors = coded.where("asks").select(columns).join(goals, "key")
    empty = F.lit(None).cast("array<array<bigint>>")
    tiles = tiled(coded.select(*columns, empty.alias("goals")), anchors.select(*columns, "goals"), "key")
    schema = "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"
    found = map_groups(tiles, _negatives(negatives, share), schema)
    return ranked(found, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.col("negative_id")], negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
