"""Profiling: one-pass table statistics, one row per column where that is the result."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import one_row, small_frame
from .cleaning import missing_cells
from .columns import categorical_columns, missing, numeric_columns
from .ordering import quantile_table


def _number(df: DataFrame, c: str) -> Column:
    value = as_column(c).cast("double")
    return F.when(~missing(df, c), value)


def _per_column(stats: DataFrame, columns: Sequence[str], fields: Sequence[str], name: str = "column") -> DataFrame:
    """Turn the one-row aggregate with columns ``field_i`` into one row per column."""
    rows = F.array(*[F.struct(F.lit(c).alias(name), *[F.col(f"{f}_{i}").alias(f) for f in fields])
                     for i, c in enumerate(columns)])
    return stats.select(F.inline(rows))


def dataset_info(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells, duplicate rows and the column lists, in one row."""
    frame = df.agg(F.count("*").alias("rows"), missing_cells(df).alias("missing_cells"))
    distinct = df.distinct().agg(F.count("*").alias("kept"))
    return frame.withColumn("_d", one_row(distinct)).select(
        "rows", F.lit(len(df.columns)).alias("columns"), "missing_cells",
        (F.col("rows") - F.col("_d.kept")).alias("duplicate_rows"),
        F.lit(",".join(df.columns)).alias("column_names"),
        F.lit(",".join(numeric_columns(df))).alias("numeric_columns"),
        F.lit(",".join(categorical_columns(df))).alias("categorical_columns"))


def describe(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric column."""
    chosen = list(columns or numeric_columns(df))
    aggs = []
    for i, c in enumerate(chosen):
        v = _number(df, c)
        aggs += [F.count(v).alias(f"count_{i}"), F.avg(v).alias(f"mean_{i}"), F.stddev_samp(v).alias(f"std_{i}"),
                 F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}")]
    stats = _per_column(df.agg(*aggs), chosen, ["count", "mean", "std", "min", "max"])
    parts = quantile_table(df, chosen, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, **options)
    return (stats.join(F.broadcast(parts), "column", "left")  # one row per column
            .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def missing_summary(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Missing count and percentage per column."""
    stats = df.agg(F.count("*").alias("_rows"),
                   *[F.count(F.when(missing(df, c), 1)).alias(f"missing_count_{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"missing_count_{i}").alias("missing_count"),
                              F.col("_rows").alias("_rows")) for i, c in enumerate(df.columns)])
    percent = F.when(F.col("_rows") > 0, F.col("missing_count") / F.col("_rows") * 100)
    table = stats.select(F.inline(rows)).select("column", "missing_count", percent.alias("missing_percent"))
    if only_missing:
        return table.where(F.col("missing_count") > 0).orderBy(F.desc("missing_count"), "column")
    return table


def count_distinct(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct present values per column; ``exact=False`` uses the HyperLogLog sketch."""
    def distinct(c):
        value = F.when(~missing(df, c), as_column(c))
        return F.count_distinct(value) if exact else F.approx_count_distinct(value)
    stats = df.agg(*[distinct(c).alias(f"unique_values_{i}") for i, c in enumerate(columns)])
    return _per_column(stats, columns, ["unique_values"])


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Distinct and missing count per text column."""
    chosen = list(columns or categorical_columns(df))
    gaps = missing_summary(df.select(*[as_column(c) for c in chosen])).select(
        "column", F.col("missing_count").alias("missing_values"))
    return count_distinct(df, chosen, exact).join(F.broadcast(gaps), "column")  # one row per column


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = 15) -> DataFrame:
    """(column, value, count, rank), most frequent first; a missing value counts as ``nan``.

    ``top=None`` keeps every value (and then gives no rank, which would order all of them).
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.coalesce(as_column(c).cast("string"), F.lit("nan")).alias("value"))
                      for c in columns])
    counts = df.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("count"))
    if top is None:
        return counts
    order = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    # row_number() <= top is pushed below the shuffle, so each task sends at most `top` rows per column
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per class."""
    counts = df.groupBy(as_column(column).alias("class")).agg(F.count("*").alias("count"))
    total = one_row(df.agg(F.count("*").alias("n")))
    return (counts.withColumn("_t", total)
            .select("class", "count", (F.col("count") / F.col("_t.n") * 100).alias("percent")))


def group_mean(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*[as_column(b) for b in by]).agg(*[F.avg(_number(df, c)).alias(f"mean_{c}") for c in columns])


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean), largest mean first."""
    stats = df.agg(*[F.avg(_number(df, c)).alias(f"mean_{i}") for i, c in enumerate(columns)])
    return _per_column(stats, columns, ["mean"]).orderBy(F.desc("mean"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair over rows where both are present: (a, b, r)."""
    chosen = list(columns or numeric_columns(df))
    pairs = list(combinations(range(len(chosen)), 2))

    def both(i, j):
        a, b = _number(df, chosen[i]), _number(df, chosen[j])
        known = a.isNotNull() & b.isNotNull()
        a, b = F.when(known, a), F.when(known, b)
        # built-in corr fails on a constant column in ANSI mode; here it is NULL
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))

    stats = df.agg(*[both(i, j).alias(f"r_{i}_{j}") for i, j in pairs],
                   *[F.when(F.min(_number(df, c)) < F.max(_number(df, c)), F.lit(1.0)).alias(f"r_{i}_{i}")
                     for i, c in enumerate(chosen)])
    rows = []
    for i, a in enumerate(chosen):
        for j, b in enumerate(chosen):
            low, high = min(i, j), max(i, j)
            rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r_{low}_{high}").alias("r")))
    return stats.select(F.inline(F.array(*rows)))


def iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5, **options) -> DataFrame:
    """Quartiles, fences and the number of rows below and above them, per column. Runs the quartile jobs."""
    found = quantile_table(df, columns, {"q1": 0.25, "q3": 0.75}, **options).collect()  # one row per column
    quart = small_frame(df.sparkSession, [tuple(r) for r in found], "column string, q1 double, q3 double")
    spread = F.col("q3") - F.col("q1")
    fences = quart.select("column", "q1", "q3", spread.alias("iqr"), (F.col("q1") - k * spread).alias("low"),
                          (F.col("q3") + k * spread).alias("high"))
    picked = fences.agg(*[F.max(F.when(F.col("column") == c, F.col(s))).alias(f"{s}_{i}")
                          for i, c in enumerate(columns) for s in ("low", "high")])
    frame = df.withColumn("_f", one_row(picked))
    counts = frame.agg(*[
        F.count(F.when(_number(df, c) < F.col(f"_f.low_{i}") if side == "below" else
                       _number(df, c) > F.col(f"_f.high_{i}"), 1)).alias(f"{side}_{i}")
        for i, c in enumerate(columns) for side in ("below", "above")])
    tails = _per_column(counts, columns, ["below", "above"])
    return (fences.join(F.broadcast(tails), "column")  # one row per column
            .withColumn("outliers", F.col("below") + F.col("above")))


def dtype_distribution(df: DataFrame) -> DataFrame:
    """Number of columns per data type, from the schema alone."""
    types = [f.dataType.simpleString() for f in df.schema.fields]
    return small_frame(df.sparkSession, [(t, types.count(t)) for t in sorted(set(types))], "dtype string, columns int")


def dedup_analysis(df: DataFrame) -> DataFrame:
    """Total, unique and duplicate rows, and the percentage kept."""
    total = df.agg(F.count("*").alias("total_rows"))
    kept = df.distinct().agg(F.count("*").alias("unique_rows"))
    share = F.when(F.col("total_rows") > 0, F.col("unique_rows") / F.col("total_rows") * 100)
    return (total.withColumn("_k", one_row(kept)).withColumn("unique_rows", F.col("_k.unique_rows"))
            .select("total_rows", "unique_rows", (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_rows"),
                    share.alias("retention_percent")))


def missing_rate(df: DataFrame) -> DataFrame:
    """Missing cells as a percentage of all cells."""
    cells = F.col("rows") * F.lit(len(df.columns))
    stats = df.agg(F.count("*").alias("rows"), missing_cells(df).alias("missing_cells"))
    return stats.select("missing_cells", cells.alias("cells"),
                        F.when(cells > 0, F.col("missing_cells") / cells * 100).alias("missing_rate"))


def gini_impurity(df: DataFrame, label: str) -> DataFrame:
    """1 - sum of squared class shares; rows without a label are left out."""
    counts = df.where(~missing(df, label)).groupBy(as_column(label)).agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    return counts.agg(F.sum("n").alias("total"), F.count("*").alias("classes"),
                      (F.lit(1.0) - F.sum(n * n) / (F.sum(n) * F.sum(n))).alias("gini"))


def summary_stats(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """count, mean, median, min and max per column."""
    return describe(df, columns, **options).select("column", "count", "mean", F.col("p50").alias("median"), "min", "max")


def covariance_2x2(df: DataFrame, a: str, b: str) -> DataFrame:
    """Sample variances, covariance and means of two columns over rows where both are present."""
    x, y = _number(df, a), _number(df, b)
    known = df.select(x.alias("x"), y.alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return known.agg(F.count("*").alias("n"), F.avg("x").alias("mean_a"), F.avg("y").alias("mean_b"),
                     F.var_samp("x").alias("var_a"), F.var_samp("y").alias("var_b"),
                     F.covar_samp("x", "y").alias("cov_ab"))


def run_profile(df: DataFrame, target: str | None = None) -> dict[str, DataFrame]:
    """Every profile table at once, each computed and kept in memory; a part that fails is not fatal.

    ``failures`` has (part, error) of those that failed while planned or run.
    """
    texts = categorical_columns(df)
    makers = {
        "dataset_info": lambda: dataset_info(df),
        "numeric_summary": lambda: describe(df),
        "missing_summary": lambda: missing_summary(df),
        "categorical_summary": lambda: categorical_summary(df),
        "value_counts": lambda: value_counts(df, texts),
        "class_distribution": lambda: class_distribution(df, target),
        "correlation_matrix": lambda: correlation_matrix(df),
    }
    tables, failures = {}, []
    for name, make in makers.items():
        try:
            made = make().persist()
            made.count()
            tables[name] = made
        except Exception as error:  # noqa: BLE001 - a profile must not fail because one part does
            failures.append((name, type(error).__name__))
    tables["failures"] = small_frame(df.sparkSession, failures, "part string, error string")
    return tables
