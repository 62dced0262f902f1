"""Reproducible random splits. Membership depends on the row's id and the seed, not on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from .ordering import hash_rank, hash_uniform


def train_test_split(df: DataFrame, ids: Sequence[str], test_size: float = 0.2, seed: int = 42,
                     mode: str = "exact", out: str = "part") -> DataFrame:
    """Add ``part`` (train/test). The test part has exactly ceil(test_size * rows) rows.

    ``mode="hash"`` draws each row on its own: no shuffle at all, sizes right on average.
    """
    if mode == "hash":
        test = hash_uniform(ids, seed) < test_size
        return df.withColumn(out, F.when(test, "test").otherwise("train"))
    ranked = hash_rank(df, ids, seed, out="_rank", total="_rows")
    test = F.col("_rank") <= F.ceil(F.col("_rows") * F.lit(float(test_size)))
    return ranked.withColumn(out, F.when(test, "test").otherwise("train")).drop("_rank", "_rows")


def stratified_split(df: DataFrame, label: str, ids: Sequence[str], test_size: float = 0.2, seed: int = 42,
                     out: str = "part") -> DataFrame:
    """Add ``part`` with ceil(test_size * rows) test rows shared out by class size.

    Each class gets the whole part of its share; the rows left over go to the largest
    remainders (the lower label on ties).
    """
    ranked = hash_rank(df, ids, seed, by=[label], out="_rank", total="_class_rows")
    classes = df.groupBy(as_column(label).alias("_class")).agg(F.count("*").alias("_n"))
    every = Window.partitionBy()
    share = F.col("_n") * F.col("_wanted") / F.col("_all")
    quotas = (classes.withColumn("_all", F.sum("_n").over(every))
              .withColumn("_wanted", F.ceil(F.col("_all") * F.lit(float(test_size))))
              .withColumn("_floor", F.floor(share)).withColumn("_rest", share - F.floor(share))
              .withColumn("_left", F.col("_wanted") - F.sum("_floor").over(every))
              .withColumn("_place", F.row_number().over(Window.orderBy(F.desc("_rest"), "_class")))
              .select("_class", (F.col("_floor") + F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0))
                      .alias("_quota")))
    joined = ranked.join(quotas, ranked[label].eqNullSafe(quotas["_class"]))
    test = F.col("_rank") <= F.col("_quota")
    return (joined.withColumn(out, F.when(test, "test").otherwise("train"))
            .select(*[as_column(c) for c in df.columns if c != out], out))


def kfold(df: DataFrame, ids: Sequence[str], k: int = 5, seed: int = 42, out: str = "fold",
          by: Sequence[str] = ()) -> DataFrame:
    """Add a fold number 0..k-1; fold sizes differ by at most one row, within each ``by`` group if given."""
    ranked = hash_rank(df, ids, seed, by=by, out="_rank")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def part_of(df: DataFrame, part: str, column: str = "part") -> DataFrame:
    return df.where(F.col(column) == part).drop(column)
