"""Cleaning: duplicates, infinities, missing values, binary targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import as_column, finite_or_null, strip_lower, to_number
from ..runtime import one_row, rows_as_struct, write_out
from .columns import (categorical_columns, missing, normalize_column_names, numeric_columns,
                      remove_empty_columns)
from .ordering import quantiles

# Texts that stand for the two classes of a yes/no target.
POSITIVE_TEXTS = ("placed", "yes", "true", "1")
NEGATIVE_TEXTS = ("not placed", "not_placed", "no", "false", "0")
UNKNOWN = "Unknown"


def remove_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def replace_infinite(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Infinite and NaN cells become NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = [c for c in floats if columns is None or c in columns]
    return df.withColumns({c: finite_or_null(c) for c in chosen}) if chosen else df


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent text per column, the smallest on ties: (column, mode)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), as_column(c).cast("string").alias("value"))
                      for c in columns])
    counts = (df.select(F.inline(cells)).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count("*").alias("n")))
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))


def column_medians(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """(column, median); exact unless ``exact=False``."""
    found = quantiles(df, columns, [0.5], **options)
    return found.select("column", F.col("q")[0].alias("median"))


def fill_numeric(df: DataFrame, columns: Sequence[str] | None = None, skip: Sequence[str] = (),
                 empty_value: float | None = 0.0, **options) -> DataFrame:
    """Missing numbers become the column median, or ``empty_value`` in an all-missing column.

    Filled columns are doubles, since the median of whole numbers may be a half.
    """
    chosen = [c for c in (columns or numeric_columns(df)) if c not in skip]
    if not chosen:
        return df
    medians = rows_as_struct(column_medians(df, chosen, **options), "column", "median", chosen)
    row = df.withColumn("_medians", medians)

    def filled(c):
        value = F.when(~missing(df, c), as_column(c).cast("double"))
        return F.coalesce(value, F.col("_medians").getField(c), F.lit(empty_value))

    return row.withColumns({c: filled(c) for c in chosen}).drop("_medians")


def fill_categorical(df: DataFrame, columns: Sequence[str] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """Missing texts become the column's mode, or ``Unknown`` where there is none."""
    chosen = [c for c in (columns or categorical_columns(df)) if c not in skip]
    if not chosen:
        return df
    modes = rows_as_struct(column_modes(df, chosen), "column", "mode", chosen)
    row = df.withColumn("_modes", modes)
    return row.withColumns({
        c: F.coalesce(as_column(c), F.col("_modes").getField(c).cast(df.schema[c].dataType),
                      F.lit(UNKNOWN) if isinstance(df.schema[c].dataType, T.StringType) else F.lit(None))
        for c in chosen}).drop("_modes")


def map_values(column: str | Column, values: Mapping) -> Column:
    """Look a value up in a small mapping; NULL where it is not listed."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs)[as_column(column)]


def clean_binary_target(df: DataFrame, column: str, positive: Sequence[str] = POSITIVE_TEXTS,
                        negative: Sequence[str] = NEGATIVE_TEXTS) -> DataFrame:
    """Texts for yes and no become 1 and 0, other texts their number; rows without a target go.

    The column ends as an integer if only 0 and 1 occur (checked by one aggregate), else as a double.
    """
    if column not in df.columns:
        raise ValueError(f"target column {column!r} is missing")
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        value = as_column(column).cast("double")
        value = F.when(~F.isnan(value), value)
    else:
        texts = {**{t: 1.0 for t in positive}, **{t: 0.0 for t in negative}}
        value = F.coalesce(map_values(strip_lower(as_column(column).cast("string")), texts),
                           to_number(as_column(column).cast("string")))
    return _as_classes(df.withColumn(column, value).where(as_column(column).isNotNull()), column)


def _as_classes(df: DataFrame, column: str) -> DataFrame:
    """Integer column if every value is 0 or 1."""
    binary = df.agg(F.bool_and(as_column(column).isin(0.0, 1.0)).alias("binary")).first()["binary"]
    return df.withColumn(column, as_column(column).cast("int")) if binary else df


def recode_two_values(df: DataFrame, column: str) -> DataFrame:
    """Of exactly two distinct values the smaller becomes 0 and the larger 1; otherwise unchanged."""
    c = as_column(column)
    ends = df.agg(F.min(c).alias("low"), F.max(c).alias("high"))
    frame = df.withColumn("_ends", one_row(ends))
    outside = frame.agg(F.count(F.when((c != F.col("_ends.low")) & (c != F.col("_ends.high")), 1)).alias("others"))
    frame = frame.withColumn("_others", one_row(outside))
    two = (F.col("_others.others") == 0) & (F.col("_ends.low") != F.col("_ends.high"))
    coded = F.when(c == F.col("_ends.low"), F.lit(0)).when(c == F.col("_ends.high"), F.lit(1))
    return frame.withColumn(column, F.when(two, coded.cast("double")).otherwise(c.cast("double"))).drop("_ends", "_others")


def clean_data(df: DataFrame, target: str | None = None, infinite_first: bool = False) -> DataFrame:
    """The whole cleaning chain.

    By default: names, empty columns, duplicates, target, fill, infinities, fill again,
    and an error if no row is left. With ``infinite_first`` infinities become missing
    before the target is cleaned and duplicates are removed; the target is not filled,
    but two-valued targets are recoded to 0 and 1. The rows without duplicates are stored
    once, since the statistics that fill the gaps read them several times.
    """
    data = remove_empty_columns(normalize_column_names(df))
    skip = [target] if target else []
    if infinite_first:
        data = replace_infinite(data)
        if target:
            data = clean_binary_target(data, target)
            if not isinstance(data.schema[target].dataType, T.IntegerType):
                data = recode_two_values(data, target)
        data = write_out(remove_duplicates(data), "distinct")
        return fill_categorical(fill_numeric(data, skip=skip), skip=skip)
    data = remove_duplicates(data)
    if target:
        data = clean_binary_target(data, target)
    data = write_out(data, "distinct")
    if data.isEmpty():
        raise ValueError("no rows remain after cleaning")
    data = fill_categorical(fill_numeric(data, skip=skip), skip=skip)
    return fill_numeric(replace_infinite(data), skip=skip)


def missing_cells(df: DataFrame) -> Column:
    """Aggregate: number of missing cells in the table."""
    total = F.lit(0)
    for c in df.columns:
        total = total + F.when(missing(df, c), 1).otherwise(0)
    return F.coalesce(F.sum(total), F.lit(0)).cast("long")


def cleaning_report(before: DataFrame, after: DataFrame, target: str | None = None) -> DataFrame:
    """Row, column, duplicate and missing counts before and after, and rows per target value."""
    distinct = before.distinct().agg(F.count("*").alias("kept"))
    first = before.agg(F.count("*").alias("rows"), missing_cells(before).alias("missing"))
    frame = after.agg(F.count("*").alias("rows_after"), missing_cells(after).alias("missing_after"))
    frame = frame.withColumn("_b", one_row(first)).withColumn("_d", one_row(distinct))
    report = frame.select(
        F.col("_b.rows").alias("rows_before"), "rows_after",
        F.lit(len(before.columns)).alias("columns_before"), F.lit(len(after.columns)).alias("columns_after"),
        (F.col("_b.rows") - F.col("_d.kept")).alias("duplicates_removed"),
        F.col("_b.missing").alias("missing_before"), "missing_after")
    if target is None:
        return report
    counts = after.groupBy(as_column(target).alias("target_value")).agg(F.count("*").alias("target_rows"))
    row = report.agg(*[F.max(c).alias(c) for c in report.columns])
    return counts.withColumn("_r", one_row(row)).select("_r.*", "target_value", "target_rows")
