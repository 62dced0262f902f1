"""Worked examples and report cards: small computed tables about a big one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column, euclidean_arrays, format_cell, format_count, row_mean, z_score
from ..operators.cleaning import fill_numeric, replace_infinite
from ..operators.columns import numeric_columns
from ..operators.prep import scale_columns
from ..operators.reduction import pca_2col
from ..operators.statistics import (dedup_analysis, dtype_distribution, gini_impurity, iqr_bounds, missing_rate,
                                    missing_summary, summary_stats)
from ..operators.windows import head_by, reservoir_sample, sample_n
from ..runtime import one_row


def preview(df: DataFrame, ids: Sequence[str], n: int = 200) -> DataFrame:
    return reservoir_sample(df, n, ids)


def feature_sample(df: DataFrame, order: Sequence[str], wanted: Sequence[str], limit: int = 10) -> DataFrame:
    """The first rows of three features as text, ``-`` for missing; the first three numeric columns if some are absent."""
    features = [c for c in wanted if c in df.columns]
    if len(features) < 3:
        features = numeric_columns(df)[:3]
    rows = head_by(df.select(*[as_column(c) for c in dict.fromkeys([*order, *features])]), order, limit)
    return rows.select(*[F.coalesce(as_column(c).cast("string"), F.lit("-")).alias(c) for c in features])


def formatted_sample(df: DataFrame, ids: Sequence[str], columns: Sequence[str], limit: int = 20, seed: int = 42) -> DataFrame:
    """A sample of rows as display text: floats with four decimals, a dash for missing."""
    kinds = dict(df.dtypes)
    return sample_n(df, limit, ids, seed).select(
        *[format_cell(c, kinds[c] in ("double", "float")).alias(c) for c in columns if c in kinds])


def pair_distance(df: DataFrame, key: str, features: Sequence[str], first, second) -> DataFrame:
    """Distance of two rows by id, on the raw columns."""
    vector = F.array(*[as_column(f).cast("double") for f in features])
    picked = df.where(as_column(key).isin(first, second)).agg(
        F.max(F.when(as_column(key) == first, vector)).alias("a"), F.max(F.when(as_column(key) == second, vector)).alias("b"))
    return picked.select(euclidean_arrays("a", "b").alias("distance"))


def standardised_pair_distance(df: DataFrame, key: str, features: Sequence[str], first, second) -> DataFrame:
    """The same after infinities and gaps are filled and columns standardised over the whole table."""
    filled = fill_numeric(replace_infinite(df.select(as_column(key), *[as_column(f) for f in features])), features)
    return pair_distance(scale_columns(filled, features), key, features, first, second)


def worked_examples(df: DataFrame, ids: Sequence[str], mean_columns: Sequence[str], distance_columns: Sequence[str],
                    label: str, n: int = 200) -> DataFrame:
    """On a sample: the row mean of its first row, the distance of its first two rows, and the Gini impurity of its labels."""
    rows = preview(df, ids, n)
    order = F.struct(*[as_column(c) for c in ids])
    vector = F.array(*[as_column(c).cast("double") for c in distance_columns])
    firsts = rows.agg(F.min_by(row_mean(mean_columns), order).alias("mean"),
                      F.slice(F.sort_array(F.collect_list(F.struct(order.alias("o"), vector.alias("v")))), 1, 2).alias("two"))
    gini = one_row(gini_impurity(rows, label))
    return firsts.withColumn("_g", gini).select(
        F.round("mean", 2).alias("row_mean"),
        F.round(euclidean_arrays(F.get("two", F.lit(0))["v"], F.get("two", F.lit(1))["v"]), 4).alias("distance"),
        F.round("_g.gini", 4).alias("gini"))


def scaling_card(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and deviation of each column before and after scaling."""
    stats = df.agg(*[F.avg(as_column(c)).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[F.stddev_samp(as_column(c)).alias(f"s{i}") for i, c in enumerate(columns)],
                   *[F.stddev_pop(as_column(c)).alias(f"p{i}") for i, c in enumerate(columns)])
    frame = df.withColumn("_s", one_row(stats))
    aggs = []
    for i, c in enumerate(columns):
        z = z_score(as_column(c), F.col(f"_s.m{i}"), F.col(f"_s.p{i}"))
        aggs += [F.avg(as_column(c)).alias(f"raw_mean_{i}"), F.stddev_samp(as_column(c)).alias(f"raw_std_{i}"),
                 F.avg(z).alias(f"scaled_mean_{i}"), F.stddev_pop(z).alias(f"scaled_std_{i}")]
    parts = ["raw_mean", "raw_std", "scaled_mean", "scaled_std"]
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{p}_{i}").alias(p) for p in parts])
                     for i, c in enumerate(columns)])
    return frame.agg(*aggs).select(F.inline(rows))


def split_card(df: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Rows per part of a split, as text with separators."""
    sizes = df.agg(F.count("*").alias("n")).withColumn("train", F.round(F.col("n") * F.lit(train_share)).cast("long"))
    rows = F.array(
        F.struct(F.lit("Training").alias("part"), format_count("train").alias("rows")),
        F.struct(F.lit("Testing").alias("part"), format_count(F.col("n") - F.col("train")).alias("rows")),
        F.struct(F.lit("Total").alias("part"), format_count("n").alias("rows")))
    return sizes.select(F.inline(rows))


def algorithm_cards(df: DataFrame, ids: Sequence[str], columns: Sequence[str], label: str) -> dict[str, DataFrame]:
    """The computed table behind each report card, plus a formatted sample of the source rows."""
    numbers = numeric_columns(df, columns)
    first_two = numbers[:2]
    return {
        "source": formatted_sample(df, ids, columns),
        "calculation": sample_n(df, 100, ids),
        "missing_values": missing_summary(df),
        "missing_rate": missing_rate(df),
        "duplicates": dedup_analysis(df),
        "data_types": dtype_distribution(df),
        "outliers": iqr_bounds(df, numbers),
        "exploration": summary_stats(df, numbers),
        "scaling": scaling_card(df, numbers),
        "row_means": df.select(*[as_column(c) for c in ids], row_mean(numbers).alias("row_mean")),
        "split": split_card(df),
        "gini": gini_impurity(df, label),
        "components": pca_2col(df, *first_two, keep=ids),
    }
