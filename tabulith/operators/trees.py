"""Decision trees, forests and boosted trees, their importances, and single exact splits."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import ensure_checkpoints, one_row, small_frame
from .histogram_forest import Forest, grow
from .ordering import running_totals, with_next


def decision_tree(train: DataFrame, label: str, features: str = "features", depth: int = 10, min_leaf: int = 5,
                  max_bins: int = 256, weight: str | None = None, seed: int = 42, min_split: int = 2) -> Forest:
    """One Gini tree on all rows and features."""
    return grow(train, label, features, 1, depth, min_split, min_leaf, max_bins=max_bins, subset=sys.maxsize,
                bootstrap=False, weight=weight, seed=seed)


def random_forest(train: DataFrame, label: str, features: str = "features", trees: int = 200, depth: int = 15,
                  min_leaf: int = 2, max_bins: int = 64, seed: int = 42, min_split: int = 2) -> Forest:
    """Gini trees on bootstrap weights, each node on a draw of the features."""
    return grow(train, label, features, trees, depth, min_split, min_leaf, max_bins=max_bins, seed=seed)


def gradient_boosting(train: DataFrame, label: str, features: str = "features", trees: int = 150, rate: float = 0.05,
                      depth: int = 3, min_leaf: int = 5, seed: int = 42, checkpoint_every: int = 10):
    """First-order boosting (leaf values are mean gradients; ``newton_boost`` takes Newton steps)."""
    ensure_checkpoints(train.sparkSession)  # else checkpoint_every has no effect
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=trees, stepSize=rate, maxDepth=depth,
                         minInstancesPerNode=min_leaf, seed=seed, checkpointInterval=checkpoint_every,
                         cacheNodeIds=True).fit(train)


def importance_table(df: DataFrame, values: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(feature, importance), largest first; ``Feature_i`` if the names do not fit."""
    if len(names) != len(values):
        names = [f"Feature_{i}" for i, _ in enumerate(values)]
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return small_frame(df.sparkSession, rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def feature_importance(model, df: DataFrame, names: Sequence[str]) -> DataFrame:
    values = model.featureImportances
    return importance_table(df, values.toArray() if hasattr(values, "toArray") else values, names)


# ---- one exact split --------------------------------------------------------

def _split_points(df: DataFrame, feature: str, measures: dict[str, Column], **options) -> DataFrame:
    """Per distinct value but the last: running sums up to it, the totals, and the midpoint threshold."""
    rows = df.where(as_column(feature).isNotNull())
    groups = rows.groupBy(as_column(feature).cast("double").alias("value")).agg(
        *[F.sum(e).alias(n) for n, e in measures.items()])
    points = running_totals(groups, "value", {**{f"left_{n}": F.col(n) for n in measures},
                                              "rank": F.lit(1).cast("long")}, **options)
    totals = one_row(groups.agg(*[F.sum(n).alias(n) for n in measures]))
    points = with_next(points, "rank", ["value"]).where(F.col("next_value").isNotNull())
    return (points.withColumn("_t", totals)
            .withColumns({f"right_{n}": F.col(f"_t.{n}") - F.col(f"left_{n}") for n in measures})
            .withColumn("threshold", (F.col("value") + F.col("next_value")) / 2.0))


def _best(points: DataFrame, gain: Column, *keep: str) -> DataFrame:
    fields = F.struct("threshold", F.col("_gain").alias("gain"), *keep)
    return (points.withColumn("_gain", gain)
            .agg(F.max_by(fields, F.struct("_gain", -F.col("threshold"))).alias("_b")).select("_b.*"))


def best_gini_split(df: DataFrame, feature: str, label: str, weight: str | None = None, **options) -> DataFrame:
    """The exact threshold with the largest drop of Gini impurity of a 0/1 label (lowest threshold on ties)."""
    w = as_column(weight).cast("double") if weight else F.lit(1.0)
    y = as_column(label) == 1
    points = _split_points(df, feature, {"pos": F.when(y, w).otherwise(0.0), "neg": F.when(~y, w).otherwise(0.0)}, **options)

    def size(side):
        return F.col(f"{side}_pos") + F.col(f"{side}_neg")

    def impurity(pos, neg):
        n = pos + neg
        return F.when(n > 0, 1 - (pos / n) * (pos / n) - (neg / n) * (neg / n)).otherwise(0.0)

    pos = F.col("left_pos") + F.col("right_pos")
    neg = F.col("left_neg") + F.col("right_neg")
    parent = impurity(pos, neg)
    left = impurity(F.col("left_pos"), F.col("left_neg"))
    right = impurity(F.col("right_pos"), F.col("right_neg"))
    # rounded, so that ties are ties whatever order the sums were taken in
    gain = F.round(parent - (size("left") * left + size("right") * right) / (pos + neg), 12)
    return _best(points, gain, "left_pos", "left_neg", "right_pos", "right_neg")


def best_newton_split(df: DataFrame, feature: str, gradient: Column, hessian: Column, lam: float = 1.0,
                      **options) -> DataFrame:
    """The exact threshold with the largest second-order gain, and the leaf values on both sides."""
    points = _split_points(df, feature, {"g": gradient, "h": hessian}, **options)

    def score(g, h):
        return g * g / (h + F.lit(lam))

    left, right = score(F.col("left_g"), F.col("left_h")), score(F.col("right_g"), F.col("right_h"))
    whole = score(F.col("left_g") + F.col("right_g"), F.col("left_h") + F.col("right_h"))
    gain = F.round(0.5 * (left + right - whole), 9)
    points = points.withColumns({"left_value": -F.col("left_g") / (F.col("left_h") + lam),
                                 "right_value": -F.col("right_g") / (F.col("right_h") + lam)})
    return _best(points, gain, "left_value", "right_value")
