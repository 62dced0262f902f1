"""Engineered score columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (as_column, finite_or_null, linear_score, min_max, row_mean, row_std, row_sum,
                                 to_number)
from ..runtime import one_row


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def _coerced(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_n{i}" for i, _ in enumerate(cols)]
    return df.withColumns({n: to_number(as_column(c).cast("string")) if dict(df.dtypes)[c] == "string"
                           else as_column(c).cast("double") for n, c in zip(names, cols)}), names


def add_row_mean(df: DataFrame, prefix: str, out: str) -> DataFrame:
    """Mean of the present values of all columns named with ``prefix``."""
    cols = columns_with_prefix(df, prefix)
    if not cols:
        return df
    frame, names = _coerced(df, cols)
    return frame.withColumn(out, row_mean(names)).drop(*names)


def add_consistency(df: DataFrame, prefix: str, out: str) -> DataFrame:
    """Sample standard deviation across the columns; 0 where it is undefined. Needs two columns."""
    cols = columns_with_prefix(df, prefix)
    if len(cols) < 2:
        return df
    frame, names = _coerced(df, cols)
    return frame.withColumn(out, F.coalesce(row_std(names), F.lit(0.0))).drop(*names)


def add_minmax_score(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Mean of the columns after each is scaled to 0..100 over the whole table."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    frame, names = _coerced(df, cols)
    ends = frame.agg(*[F.min(n).alias(f"lo{n}") for n in names], *[F.max(n).alias(f"hi{n}") for n in names])
    scaled = frame.withColumn("_ends", one_row(ends)).withColumns(
        {n: min_max(n, F.col(f"_ends.lo{n}"), F.col(f"_ends.hi{n}"), 100.0) for n in names})
    return scaled.withColumn(out, row_mean(names)).drop("_ends", *names)


def add_weighted_score(df: DataFrame, weights: Mapping[str, float], out: str) -> DataFrame:
    """Weighted sum; absent columns and missing cells count as 0."""
    cols = [c for c in weights if c in df.columns]
    if not cols:
        return df.withColumn(out, F.lit(0.0))
    frame, names = _coerced(df, cols)
    frame = frame.withColumns({n: F.coalesce(F.when(~F.isnan(n), F.col(n)), F.lit(0.0)) for n in names})
    return frame.withColumn(out, linear_score({n: weights[c] for n, c in zip(names, cols)})).drop(*names)


def add_sum_score(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Sum of the columns, missing cells as 0."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    frame, names = _coerced(df, cols)
    return frame.withColumn(out, row_sum(names)).drop(*names)


def engineer_features(df: DataFrame, prefix: str, mean_out: str, consistency_out: str,
                      minmax_scores: Mapping[str, Sequence[str]] | None = None,
                      weighted_scores: Mapping[str, Mapping[str, float]] | None = None,
                      sum_scores: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Row mean and spread, then every named score; undefined results become 0."""
    data = add_consistency(add_row_mean(df, prefix, mean_out), prefix, consistency_out)
    for out, cols in (minmax_scores or {}).items():
        data = add_minmax_score(data, cols, out)
    for out, weights in (weighted_scores or {}).items():
        data = add_weighted_score(data, weights, out)
    for out, cols in (sum_scores or {}).items():
        data = add_sum_score(data, cols, out)
    made = [c for c in data.columns if c not in df.columns]
    return data.withColumns({c: F.coalesce(finite_or_null(c), F.lit(0.0)) for c in made}) if made else data
