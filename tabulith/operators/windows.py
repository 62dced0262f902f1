"""Running values, ranks, sampling, top-k and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from .ordering import hash_key, hash_rank, row_ranks, running_totals


def running_max(df: DataFrame, order: str, column: str, by: Sequence[str] = (), out: str = "best") -> DataFrame:
    """Best value so far, within each ``by`` group. For result-sized tables (one row per trial or period)."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.max(as_column(column)).over(window))


def running_sum(df: DataFrame, order: str, column: str, by: Sequence[str] = (), out: str = "cumulative",
                **options) -> DataFrame:
    """Inclusive running sum along ``order`` (numeric, distinct); bucketed on big tables."""
    return running_totals(df, order, {out: as_column(column)}, by, **options)


def first_at_least(df: DataFrame, position: str, cumulative: str, threshold: float) -> DataFrame:
    """The smallest position whose cumulative value reaches the threshold."""
    return df.where(as_column(cumulative) >= threshold).agg(F.min(as_column(position)).alias(position))


def every_nth(df: DataFrame, order: str, tie: str, n: int = 25, **options) -> DataFrame:
    """Rows 1, n+1, 2n+1, ... in ascending order; adds their 1-based ``rank``."""
    return row_ranks(df, order, tie, **options).where((F.col("rank") - 1) % n == 0)


def row_index(df: DataFrame, order: str, tie: str, out: str = "index", **options) -> DataFrame:
    """1-based number of each row in ascending order."""
    return row_ranks(df, order, tie, out, **options)


def rank_within(df: DataFrame, by: Sequence[str], ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible shuffled rank of each row inside its group, and the group size."""
    return hash_rank(df, ids, seed, by, out="rank", total="group_rows")


def sort_by(df: DataFrame, column: str, descending: bool = True) -> DataFrame:
    return df.orderBy(as_column(column).desc() if descending else as_column(column).asc())


def top_k(df: DataFrame, column: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The k largest rows; each task keeps only k."""
    return df.orderBy(as_column(column).desc(), *[as_column(t) for t in ties]).limit(k)


def head_by(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of a named order."""
    return df.orderBy(*[as_column(c) for c in order]).limit(n)


def arg_best(df: DataFrame, score: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """The row with the best score, the lowest ``order`` on ties; per ``by`` group if named."""
    row = F.struct(*[as_column(c) for c in df.columns])
    best = F.max_by(row, F.struct(as_column(score), -as_column(order))).alias("_row")
    return df.groupBy(*by).agg(best).select("_row.*")


def sample_n(df: DataFrame, n: int, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows drawn without replacement (all rows if there are fewer), the same rows on every run."""
    return df.orderBy(hash_key(ids, seed), *[as_column(c) for c in ids]).limit(n)


def reservoir_sample(df: DataFrame, k: int, ids: Sequence[str], seed: int = 7) -> DataFrame:
    """A uniform sample of k rows in one pass: the k smallest row hashes."""
    return sample_n(df, k, ids, seed)


def union_results(*frames: DataFrame) -> DataFrame:
    """Stack result tables with different columns; what a table lacks is NULL."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(as_column(column).alias("value")).distinct().orderBy("value")


def values_within(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Whether every present value is one of ``allowed``."""
    return df.agg(F.bool_and(as_column(column).isin(*allowed)).alias("within"))


def label_count(df: DataFrame, label: str, noise: int = -1) -> DataFrame:
    """Number of clusters without the noise label, and of noise rows."""
    c = as_column(label)
    return df.agg(F.count_distinct(F.when(c != noise, c)).alias("clusters"),
                  F.count(F.when(c == noise, 1)).alias("noise_rows"))
