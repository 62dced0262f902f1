"""Searches of a stated set of query rows against all rows, in blocks.

Rows are dealt by a hash of their id into blocks of bounded size, queries likewise; each pair of a row block and a
query block is one group, which a task reads as two tables. Groups return bounded results per query, merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .words import bound_batches

ROW_BLOCK = 4096
QUERY_BLOCK = 1024


def tiled(rows: DataFrame, queries: DataFrame, key: str, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Both tables' rows once per group they belong to, grouped and sorted: (block, asks, query, *columns).

    ``query`` is 0 for rows and 1 for queries; both have the same columns. Within a group they come in order of all columns.
    """
    blocks, ways = (max(1, -(-t.count() // n)) for t, n in ((rows, row_block), (queries, query_block)))
    place = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(blocks)).cast("int")
    asks = F.pmod(F.xxhash64(key, F.lit(6)), F.lit(ways)).cast("int")
    members = rows.select(place.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(ways - 1))).alias("asks"), F.lit(0).alias("query"),
                          *rows.columns)
    asking = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), asks.alias("asks"),
                            F.lit(1).alias("query"), *rows.columns)
    return members.unionByName(asking).repartition("block", "asks").sortWithinPartitions("block", "asks", "query", *rows.columns)


def map_groups(tiles: DataFrame, function: Callable[[pa.Table, pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``function(rows, queries)`` to each group of ``tiled`` that has both."""
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(parts):
            whole = pa.Table.from_batches(parts).combine_chunks()
            n = int((whole.column("query").to_numpy() == 0).sum())
            if 0 < n < whole.num_rows:
                yield from function(whole.slice(0, n), whole.slice(n))
        own, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            block, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                here = (block[a], asks[a])
                if own and here != at:
                    yield from finish(own)
                    own = []
                at = here
                own.append(batch.slice(a, b - a))
        if own:
            yield from finish(own)
    bound_batches(tiles.sparkSession)
    return tiles.mapInArrow(groups, schema)


def ranked(found: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows per group of ``by``, with their ``rank`` from 1."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def column_matrix(column: pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """List column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def by_length(rows: pa.Table, queries: pa.Table, column: str) -> Iterator[tuple[pa.Table, pa.Table]]:
    """Rows and queries whose lists have the same length, length by length; a group has one length but for odd data."""
    def lengths(t):
        return np.diff(t.column(column).combine_chunks().offsets.to_numpy())
    mine, theirs = lengths(rows), lengths(queries)
    for n in np.unique(theirs).tolist():
        if (mine == n).any():
            yield rows.filter(pa.array(mine == n)), queries.filter(pa.array(theirs == n))


def finite(vector: str):
    """Whether a vector has components, none of them null, NaN or infinite."""
    return F.coalesce((F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
