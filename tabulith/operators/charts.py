"""The numbers behind the usual charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column, bin_index
from ..runtime import one_row
from .ordering import quantile_table, row_ranks
from .prep import scale_columns
from .statistics import class_distribution
from .windows import sample_n


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """bin, left, right, count over the whole range; empty bins count 0, per class if ``by`` is named."""
    rows = df.where(as_column(column).isNotNull())
    ends = rows.agg(F.min(as_column(column)).cast("double").alias("lo"), F.max(as_column(column)).cast("double").alias("hi"))
    placed = rows.withColumn("_e", one_row(ends)).withColumn(
        "bin", bin_index(as_column(column).cast("double"), F.col("_e.lo"), F.col("_e.hi"), bins))
    keys = [] if by is None else [as_column(by).alias("class")]
    counts = placed.groupBy(*keys, F.col("bin").cast("int").alias("bin")).agg(F.count("*").alias("count"))
    groups = ["class"] if by else []
    # one map of at most `bins` entries per class, opened again for every bin number
    packed = counts.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("m"))
    every = packed.select(*groups, "m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    spread = F.when(F.col("_e.hi") > F.col("_e.lo"), F.col("_e.hi") - F.col("_e.lo")).otherwise(1.0)
    low = F.when(F.col("_e.hi") > F.col("_e.lo"), F.col("_e.lo")).otherwise(F.col("_e.lo") - 0.5)
    width = spread / bins
    return (every.withColumn("_e", one_row(ends))
            .select(*groups, "bin", (low + F.col("bin") * width).alias("left"),
                    (low + (F.col("bin") + 1) * width).alias("right"),
                    F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).alias("count")))


def scaled_histograms(df: DataFrame, column: str, bins: int = 25) -> DataFrame:
    """The histogram before and after z-scaling, marked by ``stage``."""
    before = histogram(df, column, bins).withColumn("stage", F.lit("before"))
    after = histogram(scale_columns(df, [column]), column, bins).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


def kde(df: DataFrame, column: str, grid: int = 200, bins: int | None = None) -> DataFrame:
    """Gaussian density with Scott's bandwidth on ``grid`` points from minimum to maximum: (x, density).

    Equal values are counted first. ``bins`` moves values to that many bin centers before,
    which bounds the work on big tables at the price of an approximation.
    """
    v = as_column(column).cast("double")
    rows = df.where(as_column(column).isNotNull()).select(v.alias("v"))
    stats = rows.agg(F.count("*").cast("double").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                     F.stddev_samp("v").alias("s"))
    values = rows
    if bins is not None:
        at = bin_index("v", F.col("_e.lo"), F.col("_e.hi"), bins)
        values = rows.withColumn("_e", one_row(stats)).select(
            (F.col("_e.lo") + (at + 0.5) * (F.col("_e.hi") - F.col("_e.lo")) / bins).alias("v"))
    counted = values.groupBy("v").agg(F.count("*").alias("w"))
    points = counted.withColumn("_e", one_row(stats)).select(
        "v", "w", "_e", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    width = F.pow(F.col("_e.n"), F.lit(-0.2)) * F.col("_e.s")
    x = F.col("_e.lo") + F.col("i") * (F.col("_e.hi") - F.col("_e.lo")) / (grid - 1)
    z = (x - F.col("v")) / width
    scale = F.col("_e.n") * width * math.sqrt(2.0 * math.pi)
    return points.groupBy("i", x.alias("x")).agg(F.sum(F.col("w") * F.exp(-z * z / 2) / scale).alias("density"))


def box_stats(df: DataFrame, column: str, by: str | None = None, k: float = 1.5, **options) -> DataFrame:
    """q1, median, q3, whiskers (the last values within the fences) and outlier count, per class if named."""
    groups = ["class"] if by else []
    rows = df.select(*([as_column(by).alias("class")] if by else []), as_column(column).cast("double").alias("v"))
    rows = rows.where(F.col("v").isNotNull())
    quart = quantile_table(rows, ["v"], {"q1": 0.25, "median": 0.5, "q3": 0.75}, groups, **options).drop("column")
    reach = k * (F.col("q3") - F.col("q1"))
    quart = quart.withColumn("_lo", F.col("q1") - reach).withColumn("_hi", F.col("q3") + reach)
    if by:
        right = quart.withColumnRenamed("class", "_class")
        joined = rows.join(right, rows["class"].eqNullSafe(right["_class"])).drop("_class")
    else:
        joined = rows.withColumn("_q", one_row(quart)).select("v", "_q.*")
    inside = (F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi"))
    return joined.groupBy(*groups, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("low_whisker"), F.max(F.when(inside, F.col("v"))).alias("high_whisker"),
        F.count(F.when(~inside, 1)).alias("outliers"))


def bar_data(df: DataFrame, column: str) -> DataFrame:
    """Count, percentage and label text per class, for bars and pies."""
    shares = class_distribution(df, column)
    return shares.withColumn("label", F.format_string("%s (%s%%)", F.format_number("count", 0), F.format_number("percent", 2)))


def scatter_sample(df: DataFrame, ids: Sequence[str], actual: str, predicted: str, n: int = 500, seed: int = 42) -> DataFrame:
    """n sampled points, each with the ends of the ideal line through them."""
    points = sample_n(df.select(*[as_column(c) for c in ids], as_column(actual).alias("actual"),
                                as_column(predicted).alias("predicted")), n, ids, seed)
    ends = points.agg(F.min(F.least("actual", "predicted")).alias("lo"), F.max(F.greatest("actual", "predicted")).alias("hi"))
    return points.withColumn("_e", one_row(ends)).select(*[as_column(c) for c in ids], "actual", "predicted",
                                                         F.col("_e.lo").alias("line_low"), F.col("_e.hi").alias("line_high"))


def sorted_probability_curve(df: DataFrame, key: str, score: str, label: str, n: int = 25, **options) -> DataFrame:
    """Scores in rank order on an axis from -5 to 5; every n-th point also carries its class."""
    rows = df.select(as_column(key).alias("id"), as_column(score).alias("score"), as_column(label).alias("class"))
    ranked = row_ranks(rows, "score", "id", total="_n", **options)
    x = F.lit(-5.0) + F.when(F.col("_n") > 1, 10.0 * (F.col("rank") - 1) / F.when(F.col("_n") > 1, F.col("_n") - 1)).otherwise(0.0)
    return ranked.select("id", "rank", x.alias("x"), "score",
                         F.when((F.col("rank") - 1) % n == 0, F.col("class")).alias("class"))


def projection_data(points: DataFrame, labels: DataFrame, key: str, coordinates: Sequence[str], label: str) -> DataFrame:
    """Coordinates with the label of the same id."""
    return points.select(as_column(key), *[as_column(c) for c in coordinates]).join(
        labels.select(as_column(key), as_column(label)), key, "left")


def split_bar_data(df: DataFrame, part: str = "part") -> DataFrame:
    return class_distribution(df, part)
