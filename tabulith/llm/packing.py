"""Token ids on disk, each in the fewest bits that hold the vocabulary.

The files are a Parquet table written by Spark's committer, one row per block of whole documents, in
ascending document order. A block's payload is: ``TBP1``, bits per id, documents, one byte per document
(0 where its id is null), document ids, id offsets, and the packed ids as 32-bit words. Offsets make
any document of a block readable alone, and the ids' positions are computed, so unpacking is vectorised.

A null or empty text has only the end id. Null document ids come first; repeated rows each stay.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import load
from .words import bound_batches

BLOCK_IDS = 1 << 19  # a block is closed at so many ids
HEAD = struct.Struct("<4sBI")
_BLOCK = pa.schema([("shard", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("n_docs", pa.int64()),
                    ("before", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Little-endian fixed-width packing into 32-bit words (one spare word at the end)."""
    at = np.arange(len(ids), dtype=np.int64) * bits
    out = np.zeros((len(ids) * bits + 31) // 32 + 1, np.uint32)
    if len(ids):
        wide = ids.astype(np.uint64) << (at & 31).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        joined = np.bitwise_or.reduceat(wide, first)
        out[word[first]] |= joined.astype(np.uint32)
        out[word[first] + 1] |= (joined >> np.uint64(32)).astype(np.uint32)
    return out


def unpack(words: np.ndarray, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop-1 of a packed block."""
    at = np.arange(start, stop, dtype=np.int64) * bits
    word = at >> 5
    wide = words[word].astype(np.uint64) | (words[word + 1].astype(np.uint64) << np.uint64(32))
    return ((wide >> (at & 31).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def write_block(keys: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    known = np.array([k is not None for k in keys], np.uint8)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    return b"".join([HEAD.pack(b"TBP1", bits, len(keys)), known.tobytes(),
                     np.array([k or 0 for k in keys], "<i8").tobytes(), offsets.tobytes(),
                     pack(ids, bits).astype("<u4").tobytes()])


class Block:
    """A block's documents; ``ids(i)`` reads one of them."""

    def __init__(self, payload: bytes):
        magic, self.bits, n = HEAD.unpack_from(payload)
        if magic != b"TBP1":
            raise ValueError("not a packed block")
        at = HEAD.size
        known = np.frombuffer(payload, np.uint8, n, at)
        keys = np.frombuffer(payload, "<i8", n, at + n)
        self.keys = [int(k) if v else None for k, v in zip(keys, known)]
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at + 9 * n).astype(np.int64)
        self.words = np.frombuffer(payload, "<u4", -1, at + 9 * n + 8 * (n + 1))

    def ids(self, i: int) -> np.ndarray:
        return unpack(self.words, self.bits, int(self.offsets[i]), int(self.offsets[i + 1]))

    def all_ids(self) -> np.ndarray:
        return unpack(self.words, self.bits, 0, int(self.offsets[-1]))


def write_ids(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text",
              end: int | None = 1, block_ids: int = BLOCK_IDS) -> None:
    """Encode the texts, append ``end`` to each and write packed blocks in ascending ``key`` order."""
    bound_batches(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        bits = max(1, (bpe.size - 1).bit_length())
        shard, before = TaskContext.get().partitionId(), 0
        keys, lengths, parts = [], [], []

        def closed() -> pa.RecordBatch:
            nonlocal before
            n = sum(lengths)
            row = [shard, keys[0], keys[-1], len(keys), before, n,
                   write_block(keys, lengths, np.concatenate(parts), bits)]
            before += n
            keys.clear(), lengths.clear(), parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK)

        tail = np.array([] if end is None else [end], np.int32)
        held = 0
        for batch in batches:
            names, i = batch.column(0).to_pylist(), 0
            for ids, begins in bpe.encode_array(batch.column(1)):
                for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
                    keys.append(names[i])
                    parts.append(np.concatenate([ids[a:b], tail]))
                    lengths.append(len(parts[-1]))
                    held += lengths[-1]
                    i += 1
                    if held >= block_ids:
                        held = 0
                        yield closed()
        if keys:
            yield closed()

    ordered = (docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
               .repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first()))
    (ordered.mapInArrow(blocks, "shard int, first_doc bigint, last_doc bigint, n_docs bigint, before bigint, "
                                "n_ids bigint, payload binary")
     .write.option("compression", "none").mode("overwrite").parquet(path))


def with_start(blocks: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all blocks before. Only one row per shard (a written partition) is ordered in one place."""
    shards = blocks.groupBy("shard").agg((F.max(F.col("before") + F.col("n_ids"))).alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(base), "shard").withColumn("start", F.col("base") + F.col("before"))


def read_ids(spark: SparkSession, path: str, of_block, schema: str, *columns: str) -> DataFrame:
    """Read blocks back: ``of_block(Block, start)`` gives the rows of one block as a record batch of ``schema``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield of_block(Block(payload.as_py()), start)
    bound_batches(spark)  # blocks are megabytes
    return with_start(spark.read.parquet(path)).select("start", "payload").mapInArrow(rows, schema)


def lookup(spark: SparkSession, path: str, key: int) -> list[np.ndarray]:
    """Random access: the ids of each row with this document id; Parquet skips the blocks outside its range."""
    near = spark.read.parquet(path).where((F.col("first_doc") <= key) & (F.col("last_doc") >= key))
    return [b.ids(i) for r in near.select("payload").collect() for b in [Block(r[0])]
            for i, k in enumerate(b.keys) if k == key]
