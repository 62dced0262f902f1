"""Vectorised word hashing inside Arrow tasks.

Texts stay Arrow buffers: a byte table lower-cases A-Z and marks separators, and a prefix sum of
byte values times powers gives every word a 64-bit hash without making a Python string.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BLOCK = 1 << 19  # bytes hashed at once: keeps the temporary arrays near 20 MB
SPACE = [0x20, *range(0x09, 0x0E)]
NOT_ALNUM = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
BATCH_BYTES = 16 << 20
SMALL_BATCH = 4 << 20  # where a task's work doesn't gain from more: each batch is held in the executor and in its worker

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240501)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a bijection of 64-bit integers)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(multiplier^i, multiplier^-i) modulo 2^64 for i below at least n."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, BLOCK + 1)
        inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
        up, down = np.full(n, _MULTIPLIER, np.uint64), np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


_holder: list = []


def claim_memory(owner) -> None:
    """Let one object of a worker process remember words: when another begins, the one before forgets what it kept."""
    if not _holder or _holder[0] is not owner:
        release_memory()
        _holder[:] = [owner]


def release_memory() -> None:
    """Forget what this worker process remembers and return the memory to the system: idle workers live on beside busy ones."""
    if _holder:
        _holder.pop().forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed pages otherwise
    if trim:
        trim(0)


def separator_table(separators: list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[separators] = True
    return table


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return content[bounds[0]:bounds[-1]], bounds - bounds[0]


def _blocks(content: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of at most BLOCK bytes that fall on separators, or longer where one word is."""
    start, n = 0, len(content)
    while start < n:
        end = min(n, start + BLOCK)
        if end < n:
            inside = np.flatnonzero(separator[content[start:end]])
            if len(inside):
                end = start + int(inside[-1]) + 1
            else:
                while end < n and not separator[content[end]]:
                    end += 1
        yield start, end
        start = end


@dataclass
class Hashed:
    """The words of a column of texts, in order."""
    hashes: np.ndarray
    bounds: np.ndarray  # where each text's words begin
    first: np.ndarray  # each word's place in the content
    length: np.ndarray
    content: np.ndarray

    def ends(self) -> np.ndarray:
        """Last two bytes of each word, the only one twice, with A-Z in lower case."""
        last = self.first + self.length - 1
        before = _LOWER[self.content[np.maximum(last - 1, self.first)]]
        return before.astype(np.uint16) << 8 | _LOWER[self.content[last]]


def hash_words(texts: pa.Array, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts in order, offsets of each text's words), A-Z in lower case."""
    found = hash_spans(texts, separator)
    return found.hashes, found.bounds


def hash_spans(texts: pa.Array, separator: np.ndarray, fold: bool = True) -> Hashed:
    """Hashes and places of all words; ``fold`` lower-cases A-Z first."""
    content, bounds = text_buffers(texts)
    starts = np.zeros(len(content) + 1, bool)
    starts[bounds] = True  # a text's first byte begins a word even after a text without separator
    hashes, where, lengths = [], [], []
    for begin, end in _text_blocks(content, bounds, separator[_LOWER] if fold else separator):
        part = content[begin:end]
        if fold:
            part = _LOWER[part]
        outside = separator[part]
        fresh = starts[begin:end].copy()
        fresh[0] = True
        fresh[1:] |= outside[:-1]
        first = np.flatnonzero(fresh & ~outside)
        if not len(first):
            continue
        closes = np.empty(len(part), bool)
        closes[:-1] = outside[1:] | starts[begin + 1:end]
        closes[-1] = True
        last = np.flatnonzero(closes & ~outside)
        up, down = _power_tables(len(part) + 1)
        weighted = _VALUES[part] * up[:len(part)]
        sums = np.cumsum(weighted, dtype=np.uint64)
        raw = (sums[last] - sums[first] + weighted[first]) * down[first]
        hashes.append(mix(raw ^ (last - first).astype(np.uint64)))
        where.append(first + begin)
        lengths.append(last - first + 1)
    if not hashes:
        none = np.zeros(0, np.int64)
        return Hashed(np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), none, none, content)
    first = np.concatenate(where)
    return Hashed(np.concatenate(hashes), np.searchsorted(first, bounds).astype(np.int64), first, np.concatenate(lengths),
                  content)


def text_runs(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes of text, in order."""
    _, bounds = text_buffers(texts)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
        yield texts.slice(start, stop - start)
        start = stop


def _text_blocks(content: np.ndarray, bounds: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    """Whole texts together while they fit a block; a longer text is cut at separators."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + BLOCK, "right")) - 1)
        begin, end = int(bounds[i]), int(bounds[j])
        if end - begin <= BLOCK:
            if end > begin:
                yield begin, end
        else:
            for a, b in _blocks(content[begin:end], separator):
                yield begin + a, begin + b
        i = j


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (the last k - 1 positions are left out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * _MULTIPLIER + words[i:i + n]
    return mix(out)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles of one text; a shorter text is one shingle, no words give none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(grams(words, min(k, len(words))))


def map_batches(docs: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so that long texts don't fill a worker's memory."""
    bound_batches(docs.sparkSession)
    return docs.mapInArrow(function, schema)


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
