"""Projection, column selection, casting and schema checks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import as_column, to_number
from ..runtime import small_frame


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Trim names and turn line breaks into blanks."""
    return df.toDF(*[re.sub(r"[\r\n]+", " ", c).strip() for c in df.columns])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every column it lacks. Runs no job."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError("missing columns: " + ", ".join(absent))
    return df


def select_features(df: DataFrame, wanted: Sequence[str], target: str | None = None) -> DataFrame:
    return df.select(*[as_column(c) for c in wanted if c in df.columns and c != target])


def numeric_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and (among is None or f.name in among)]


def categorical_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and (among is None or f.name in among)]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns; names that are absent are ignored."""
    return df.drop(*columns)


def missing(df: DataFrame, column: str) -> Column:
    """True where the cell is NULL or NaN."""
    c = as_column(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def remove_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single present value. Runs one aggregate over the table."""
    row = df.agg(*[F.count(F.when(~missing(df, c), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[as_column(c) for i, c in enumerate(df.columns) if row[f"n{i}"] > 0])


def filter_not_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for c in subset:
        condition = condition & ~missing(df, c)
    return df.where(condition)


def safe_numeric(df: DataFrame, column: str, default: float | None = None, out: str | None = None) -> DataFrame:
    """Coerce a column to double; an absent column becomes NULL or ``default``."""
    if column in df.columns:
        value = to_number(column, default)
    else:
        value = F.lit(default).cast("double")
    return df.withColumn(out or column, value)


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(as_column(column) == F.lit(value))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def feature_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many columns there were, are, and which are new."""
    new = [c for c in after.columns if c not in before.columns]
    return small_frame(after.sparkSession,
                       [(len(before.columns), len(after.columns), len(new), new)],
                       "columns_before int, columns_after int, new_columns int, names array<string>")


def cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: as_column(c).cast(t) for c, t in types.items()})


def wide_to_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                 name: str = "column", value: str = "value") -> DataFrame:
    """One row per (input row, column)."""
    return df.unpivot([as_column(k) for k in keys], [as_column(c) for c in columns], name, value)


def fill_constant(df: DataFrame, value, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace missing cells: a number in numeric columns, a text in text columns."""
    return df.na.fill(value, subset=list(columns) if columns else None)
