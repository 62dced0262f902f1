"""Benchmark decontamination by winnowing.

Every window of ``window`` words keeps the smallest hash of its ``gram``-word grams (window - gram + 1
of them), so any shared span of ``window`` words yields a shared fingerprint on both sides. A
document's fingerprints are tested against a bit table of the items' fingerprints, whose size is a
fixed parameter; the windows that chose a matching fingerprint are extended to their full hash and
joined with the items' windows. Items shorter than a window are one window of their own length.

Nulls, empty texts and texts without words have no words and no hits. Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulith.runtime import write_out

from .words import NOT_ALNUM, bound_batches, grams, hash_words, separator_table

FILTER_BITS = 23  # the bit table has 2^23 bits (1 MB) whatever the benchmark's size
BROADCAST_WINDOWS = 200_000  # item windows are broadcast while they and their item ids are at most so many numbers

_WINDOWS = pa.list_(pa.struct([("win", pa.int64()), ("start", pa.int32()), ("size", pa.int32())]))
_ITEM = pa.struct([("n_words", pa.int32()), ("windows", pa.list_(pa.struct([
    ("win", pa.int64()), ("mark", pa.int64()), ("size", pa.int32())])))])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _inside(bounds: np.ndarray, n: int, size: int) -> np.ndarray:
    """Positions from which ``size`` words lie in one text."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    return np.flatnonzero(np.arange(n) + size <= ends)


def _fingerprints(words: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts, smallest gram hash of each window)."""
    starts = _inside(bounds, len(words), window)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    return starts, sliding_min(grams(words, gram), window - gram + 1)[starts]


def _items_udf(window: int, gram: int, separators: list[int]):
    @F.arrow_udf("struct<n_words:int,windows:array<struct<win:bigint,mark:bigint,size:int>>>")
    def windows(texts: pa.Array) -> pa.Array:
        words, bounds = hash_words(texts, separator_table(separators))
        rows = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own, n = words[a:b], int(b - a)
            if n >= window:
                _, marks = _fingerprints(own, np.array([0, n]), window, gram)
                full = grams(own, window)
            else:
                full = marks = grams(own, n) if n else np.zeros(0, np.uint64)
            rows.append({"n_words": n, "windows": [
                {"win": w, "mark": m, "size": min(n, window)}
                for w, m in zip(full.view(np.int64).tolist(), marks.view(np.int64).tolist())]})
        return pa.array(rows, _ITEM)
    return windows


def _hits_udf(table, short: list[int], window: int, gram: int, separators: list[int]):
    mask = np.uint64(len(table.value) * 8 - 1)

    def seen(marks: np.ndarray) -> np.ndarray:
        at = (marks & mask).astype(np.int64)
        return (table.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    @F.arrow_udf("struct<n_words:int,windows:array<struct<win:bigint,start:int,size:int>>>")
    def windows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        separator = separator_table(separators)
        for texts in batches:
            words, bounds = hash_words(texts, separator)
            starts, marks = _fingerprints(words, bounds, window, gram)
            found, full, size = [], [], []
            if len(starts):
                # consecutive windows mostly keep one fingerprint: each run of it is looked up once
                fresh = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]]))
                runs = np.diff(np.append(fresh, len(marks)))
                hit = starts[np.repeat(seen(marks[fresh]), runs)]
                found.append(hit)
                full.append(grams(words, window)[hit])
                size.append(np.full(len(hit), window, np.int32))
            for s in short:
                at = _inside(bounds, len(words), s)
                own = grams(words, s)[at] if len(at) else np.zeros(0, np.uint64)
                hit = seen(own) if len(own) else np.zeros(0, bool)
                found.append(at[hit])
                full.append(own[hit])
                size.append(np.full(int(hit.sum()), s, np.int32))
            at = np.concatenate(found) if found else np.zeros(0, np.int64)
            order = np.argsort(at, kind="stable")
            at = at[order]
            full = np.concatenate(full)[order].view(np.int64) if found else np.zeros(0, np.int64)
            size = np.concatenate(size)[order] if found else np.zeros(0, np.int32)
            owner = np.searchsorted(bounds, at, "right") - 1
            while len(at) and (empty := bounds[owner + 1] <= at).any():  # texts without words share a bound
                owner = owner + empty
            cuts = np.searchsorted(owner, np.arange(len(bounds))).astype(np.int32)
            values = pa.StructArray.from_arrays(
                [pa.array(full), pa.array((at - bounds[owner]).astype(np.int32) if len(at) else at.astype(np.int32)),
                 pa.array(size)], fields=list(_WINDOWS.value_type))
            lists = pa.ListArray.from_arrays(pa.array(cuts), values)
            yield pa.StructArray.from_arrays([pa.array(np.diff(bounds).astype(np.int32)), lists],
                                             names=["n_words", "windows"])
    return windows


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = 13, gram: int = 5,
                 separators: list[int] = NOT_ALNUM) -> DataFrame:
    """(win, mark, size, items): each distinct window of the items, its fingerprint and the items that hold it."""
    bound_batches(benchmark.sparkSession)
    own = benchmark.select(F.col(item).alias("item"), _items_udf(window, gram, separators)(F.col(text)).alias("w"))
    return (own.select("item", F.inline("w.windows")).groupBy("win", "mark", "size")
            .agg(F.array_sort(F.collect_set("item")).alias("items")))


def fingerprint_bits(windows: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The fingerprints as a bit table of fixed size; at most 2^(bits - 6) rows come back, whatever the benchmark."""
    low = F.col("mark").bitwiseAND(F.lit((1 << bits) - 1))
    words = (windows.select(F.shiftright(low, 6).alias("slot"), low.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("slot").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("w")))
    out = np.zeros(1 << (bits - 6), np.int64)
    for slot, w in words.collect():
        out[slot] = w
    return out.view(np.uint8)


def _merged(spans: Column) -> Column:
    """Union of (start, stop) spans sorted by start."""
    def step(done, s):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= s["start"]), joined).otherwise(
            F.concat(done, F.array(s)))
    return F.aggregate(spans, F.expr("cast(array() as array<struct<start:int,stop:int>>)"), step)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = 13, gram: int = 5,
                  separators: list[int] = NOT_ALNUM) -> DataFrame:
    """One row per row of ``docs``: key, text_hash, n_words, spans (merged word ranges that lie in an occurrence of an
    item's window, as start and stop) and items (ids of the items with occurring windows, sorted).

    Item windows are broadcast only up to BROADCAST_WINDOWS of them, else joined by a shuffle; the
    windows that reach the join are those whose fingerprint is in the bit table.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    wins = write_out(item_windows(benchmark, item, item_text, window, gram, separators), "item-windows")
    short = [r["size"] for r in wins.where(F.col("size") < window).select("size").distinct().collect()]
    bits = fingerprint_bits(wins)
    ids = wins.select("win", "size", "items")
    if (ids.agg(F.sum(F.size("items") + 2)).first()[0] or 0) <= BROADCAST_WINDOWS:
        ids = F.broadcast(ids)
    own = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text_hash"),
                      _hits_udf(spark.sparkContext.broadcast(bits), sorted(short), window, gram, separators)(F.col(text)).alias("h"))
    # every row of docs has one marker (a window of size 0), so that rows without hits stay and repeats are counted
    # never null: a test that it isn't would be pushed below the texts' own pass, which would then run twice
    n_words = F.coalesce(F.col("h.n_words"), F.lit(0)).alias("n_words")
    marked = own.select("key", "text_hash", n_words, F.inline(F.concat(
        F.array(F.struct(F.lit(0).cast("bigint").alias("win"), F.lit(0).alias("start"), F.lit(0).alias("size"))),
        F.col("h.windows"))))
    met = marked.join(ids, ["win", "size"], "left").where((F.col("size") == 0) | F.col("items").isNotNull())
    span = F.when(F.col("size") > 0, F.struct("start", (F.col("start") + F.col("size")).alias("stop")))
    found = met.groupBy("key", "text_hash", "n_words").agg(
        F.sum(F.when(F.col("size") == 0, 1)).alias("copies"), F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.flatten(F.collect_set("items"))).alias("items"))
    rows = found.select("key", "text_hash", "n_words", "spans", F.array_distinct("items").alias("items"),
                        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return rows.select(F.col("key").alias(key), "text_hash", "n_words", _merged(F.col("spans")).alias("spans"), "items")


def contaminated_words(spans: Column) -> Column:
    """Number of words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words, and at least one, lies in an item's window."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
