"""Spelling variants: words one edit apart, by dense prefix-suffix tiles.

Two words are one inserted, deleted or replaced code point apart if they differ and their common prefix and common suffix
together reach the longer one's length minus one. So one of the two reaches half of that, and words of lengths n and n + 1 need
only be compared where they share their first or their last half. Words are laid out by these halves; runs of words of
one half are cut into tiles of bounded size, and a task compares tiles pairwise as padded matrices of code points: common
prefixes from the left-aligned ones, common suffixes from the right-aligned ones. A pair that shares both halves is
taken where it shares the first. Half a dozen equal words or half of all words in one run only make more tiles.

What leaves a tile is one row per word: how many words are near it there, and the most frequent. A word's form is
its most frequent near word, if that occurs at least twice as often; forms lead from word to word to a root, and since each is at
least twice as frequent as the one before, pointers reach the root after at most six doublings.

Null texts have no words. Repeated rows count each time. A row without an id counts its words as they are. No words give no
rows; further columns are ignored. Long words make smaller tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.runtime import cut_lineage, write_out

from .words import bound_batches

RUN = "[A-Za-zÀ-ÿ]+"
DELETE_EVERY = 97
TILE = 2048  # words of a tile; fewer of long words, so that a tile holds at most TILE_LETTERS
TILE_LETTERS = 1 << 20
STRIP = 128  # words compared with as many others at once
CHUNK_LETTERS = 1 << 22
DOUBLINGS = 6  # chains have at most 63 steps: counts are below 2^63 and double


def count_words(docs: DataFrame, key: str, text: str, length: int, least: int) -> DataFrame:
    """(word, n): words of at least ``length`` code points that occur ``least`` times or more. Of every 97th word of a
    document, by a hash of id and word, one code point is deleted first."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.col(key).cast("string").alias("k"), F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("w"))
    h = F.crc32(F.concat("k", F.lit(":"), "w").cast("binary"))
    at = (h % F.char_length("w")).cast("int")
    shorter = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.char_length("w")))
    word = F.when(h % DELETE_EVERY == 0, shorter).otherwise(F.col("w"))
    kept = runs.select(word.alias("word")).where(F.char_length("word") >= length)
    return kept.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _tiled(words: DataFrame) -> DataFrame:
    """(short, side, half, i, j, tile, word, n): each word once per pair of tiles that it takes part in.

    ``short`` is the shorter length of the pairs sought in a run, ``half`` the shared beginning (side 0) or end (side 1).
    """
    size = F.char_length("word")
    laid = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short")).where("short > 0")
    k = F.ceil(F.col("short") / 2 - F.lit(0.5)).cast("int")  # half of the longer length minus one, for pairs of equal length
    laid = laid.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).withColumn(
        "half", F.when(F.col("side") == 0, F.substring("word", F.lit(1), k)).otherwise(F.substring("word", -k, k)))
    run = ["short", "side", "half"]
    sizes = laid.groupBy(*run).agg(F.count("*").alias("words")).where("words > 1")
    room = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_LETTERS) / F.col("short"))))
    many = sizes.select(*run, F.ceil(F.col("words") / room).cast("int").alias("tiles"))
    placed = laid.join(many, run).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    first = F.transform(F.sequence(F.lit(0), F.col("tile")), lambda i: F.struct(i.alias("i"), F.col("tile").alias("j")))
    second = F.transform(F.sequence(F.col("tile"), F.col("tiles") - 1), lambda j: F.struct(F.col("tile").alias("i"), j.alias("j")))
    return placed.select(*run, "tile", "word", "n", F.explode(F.array_distinct(F.concat(first, second))).alias("at")).select(
        *run, "at.i", "at.j", "tile", "word", "n")


def _points(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points, one row per word, padded with zeros on the right, or on the left."""
    fill = str.rjust if right else str.ljust
    return np.frombuffer("".join([fill(w, width, "\0") for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(
        len(words), width)


def common(a: np.ndarray, b: np.ndarray, columns) -> np.ndarray:
    """How many of the columns, in the order given, agree from the first on, for every row of a and of b."""
    alive = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.int32)
    for c in columns:
        alive &= a[:, c, None] == b[None, :, c]
        if not alive.any():
            break
        total += alive
    return total


def near_pairs(words: list[str], run: np.ndarray, tile: np.ndarray, crossed: np.ndarray, short: np.ndarray, side: np.ndarray,
               ) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs of words that stand in one run (equal ``run``, rows in its order); in crossed runs
    only pairs from two tiles."""
    size = np.array([len(w) for w in words])
    left, right = [], []
    start = 0
    while start < len(words):
        # strips of about as many letters whatever the words' length
        strip = max(1, min(STRIP, CHUNK_LETTERS // (8 * max(1, int(size[start])))))
        stop = min(len(words), start + strip)
        last = int(np.searchsorted(run, run[stop - 1], "right"))
        width = int(size[start:last].max())
        ahead, behind = _points(words[start:stop], width, False), _points(words[start:stop], width, True)
        for low in range(start, last, strip):
            high = min(last, low + strip)
            ahead2, behind2 = _points(words[low:high], width, False), _points(words[low:high], width, True)
            la, lb = size[start:stop, None], size[None, low:high]
            longer, shorter = np.maximum(la, lb), np.minimum(la, lb)
            may = (run[start:stop, None] == run[None, low:high]) & (longer - shorter <= 1) & (shorter == short[start:stop, None])
            may &= ~crossed[start:stop, None] | (tile[start:stop, None] != tile[None, low:high])
            may &= np.arange(start, stop)[:, None] < np.arange(low, high)[None, :]
            if not may.any():
                continue
            prefix = np.minimum(common(ahead, ahead2, range(width)), shorter)
            suffix = np.minimum(common(behind, behind2, range(width - 1, -1, -1)), shorter)
            half = np.ceil(short[start:stop] / 2 - 0.5).astype(np.int64)
            # what shares both halves is taken where it shares the first
            may &= (side[start:stop, None] == 0) | (prefix < half[:, None])
            x, y = np.nonzero(may & (prefix + suffix >= longer - 1))
            left.append(x + start)
            right.append(y + low)
        start = stop
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _near(tiles: DataFrame) -> DataFrame:
    """(word, near, best_n, best): per tile, how many words are near and the most frequent of them."""
    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        short, side, tile = (rows.column(c).to_numpy() for c in ("short", "side", "tile"))
        i, j, n = (rows.column(c).to_numpy() for c in ("i", "j", "n"))
        half = rows.column("half").combine_chunks().dictionary_encode().indices.to_numpy()
        change = np.zeros(len(rows), bool)
        for x in (short, side, half, i, j):
            change[1:] |= x[1:] != x[:-1]
        words = rows.column("word").to_pylist()
        a, b = near_pairs(words, np.cumsum(change), tile, i != j, short, side)
        if not len(a):
            return
        of, other = np.concatenate([a, b]), np.concatenate([b, a])
        met, place = np.unique(other, return_inverse=True)
        rank = np.empty(len(met), np.int64)
        rank[np.argsort(np.array([words[m] for m in met], dtype=object), kind="stable")] = np.arange(len(met))
        order = np.lexsort((rank[place], -n[other], of))
        of, other = of[order], other[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        count = np.diff(np.r_[first, len(of)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[w] for w in of[first]], pa.string()), pa.array(count, pa.int64()), pa.array(n[other[first]], pa.int64()),
             pa.array([words[w] for w in other[first]], pa.string())], ["word", "near", "best_n", "best"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        letters = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            letters += 4 * (batch.column("word").nbytes + 64 * batch.num_rows)
            if letters < CHUNK_LETTERS:
                continue
            whole = pa.Table.from_batches(kept).combine_chunks()
            # the last tile may go on in the next batch
            last = whole.slice(len(whole) - 1)
            same = np.ones(len(whole), bool)
            for c in ("short", "side", "i", "j"):
                same &= whole.column(c).to_numpy() == last.column(c)[0].as_py()
            same &= np.array([h == last.column("half")[0].as_py() for h in whole.column("half").to_pylist()])
            cut = len(whole) - int(same.sum())
            if cut:
                yield from compare(whole.slice(0, cut))
            kept = whole.slice(cut).to_batches()
            letters = sum(4 * (k.column("word").nbytes + 64 * k.num_rows) for k in kept)
        if kept:
            yield from compare(pa.Table.from_batches(kept).combine_chunks())
    bound_batches(tiles.sparkSession)
    run = ["short", "side", "half", "i", "j"]
    dealt = tiles.repartition(*run).sortWithinPartitions(*run, "word")
    return dealt.mapInArrow(groups, "word string, near bigint, best_n bigint, best string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word with a form: pointers (word, form) followed to their end by doubling."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        next_step = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        at = cut_lineage(at.join(next_step, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if at.where("moved").limit(1).count() == 0:
            break
        at = at.drop("moved")
    return at.select("word", "root")


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 5, least: int = 3) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``length`` code points that occurs ``least`` times."""
    words = write_out(count_words(docs, key, text, length, least), "words")
    near = _near(_tiled(words)).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    known = write_out(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("b.m") >= 2 * F.col("n"), F.col("b.best")).alias("form"),
        F.when(-F.col("b.m") >= 2 * F.col("n"), -F.col("b.m")).alias("form_n")), "near-words")
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
