"""Exact evaluation metrics as aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import one_row
from .ordering import running_totals, with_next


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """mae, mse, rmse, r2 in one pass, over the rows that have both label and prediction."""
    y, p = as_column(label).cast("double"), as_column(prediction).cast("double")
    error = y - p
    y = F.when(error.isNotNull(), y)
    stats = df.agg(F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"), F.var_pop(y).alias("_var"))
    r2 = F.when(F.col("_var") > 0, 1 - F.col("mse") / F.col("_var")).when(F.col("mse") == 0, 1.0).otherwise(0.0)
    return stats.select("mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tn, fp, fn, tp of a 0/1 label."""
    y, p = as_column(label) == 1, as_column(prediction) == 1
    return df.agg(F.count(F.when(~y & ~p, 1)).alias("tn"), F.count(F.when(~y & p, 1)).alias("fp"),
                  F.count(F.when(y & ~p, 1)).alias("fn"), F.count(F.when(y & p, 1)).alias("tp"))


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """accuracy, precision, recall, f1 of a 0/1 label; undefined ratios are 0."""
    cells = confusion_matrix(df, label, prediction)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"),
                        _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def _score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    y = as_column(label) == 1
    return (df.where(as_column(label).isNotNull() & as_column(score).isNotNull())
            .groupBy(as_column(score).cast("double").alias("threshold"))
            .agg(F.count(F.when(y, 1)).alias("pos"), F.count(F.when(~y, 1)).alias("neg")))


def roc_auc(df: DataFrame, label: str, score: str, single_class: float = 0.0, **options) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; ``single_class`` if only one class occurs."""
    groups = running_totals(_score_groups(df, label, score), "threshold", {"_above": F.col("pos")},
                            descending=True, **options)
    wins = F.sum(F.col("neg") * (F.col("_above") - F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return groups.agg(wins.alias("_wins"), pairs.alias("_pairs")).select(
        F.when(F.col("_pairs") > 0, F.col("_wins") / F.when(F.col("_pairs") > 0, F.col("_pairs")))
        .otherwise(F.lit(single_class)).alias("roc_auc"))


def classification_metrics(df: DataFrame, label: str, prediction: str, score: str | None = None,
                           single_class: float = 0.0, **options) -> DataFrame:
    """accuracy, precision, recall, f1 and, with a score column, roc_auc."""
    scores = classification_scores(df, label, prediction)
    if score is None:
        return scores
    area = roc_auc(df, label, score, single_class, **options)
    return scores.withColumn("_a", one_row(area)).withColumn("roc_auc", F.col("_a.roc_auc")).drop("_a")


def roc_points(df: DataFrame, label: str, score: str, **options) -> DataFrame:
    """threshold, cumulative tp and fp, fpr and tpr per distinct score, highest first, numbered by rank."""
    groups = running_totals(_score_groups(df, label, score), "threshold",
                            {"tp": F.col("pos"), "fp": F.col("neg"), "rank": F.lit(1).cast("long")},
                            descending=True, **options)
    totals = one_row(groups.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")))
    return (groups.withColumn("_t", totals)
            .withColumn("fpr", _ratio(F.col("fp"), F.col("_t.n"))).withColumn("tpr", _ratio(F.col("tp"), F.col("_t.p")))
            .drop("_t"))


def roc_curve(df: DataFrame, label: str, score: str, drop_collinear: bool = True, **options) -> DataFrame:
    """Curve points (threshold, fpr, tpr) including the start at an infinite threshold.

    Points on a straight line between their neighbours are dropped unless told otherwise.
    """
    points = roc_points(df, label, score, **options)
    if drop_collinear:
        points = with_next(points, "rank", ["pos", "neg"])
        bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        points = points.where((F.col("rank") == 1) | F.col("next_pos").isNull() | bend)
    start = points.sparkSession.range(1).select(
        F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points.select("threshold", "fpr", "tpr"))


def youden_threshold(df: DataFrame, label: str, score: str, **options) -> DataFrame:
    """The threshold with the largest tpr - fpr (the highest such threshold)."""
    curve = roc_curve(df, label, score, drop_collinear=False, **options)
    gap = F.col("tpr") - F.col("fpr")
    return curve.agg(F.max_by("threshold", F.struct(gap, "threshold")).alias("threshold"),
                     F.max(gap).alias("youden_j"))


def brier_score(df: DataFrame, label: str, score: str, calibrated: str | None = None) -> DataFrame:
    """Mean squared error of a probability; with ``calibrated`` also after, and the improvement."""
    y = as_column(label).cast("double")

    def mean_square(c):
        gap = as_column(c) - y
        return F.avg(gap * gap)

    if calibrated is None:
        return df.agg(mean_square(score).alias("brier"))
    stats = df.agg(mean_square(score).alias("brier_before"), mean_square(calibrated).alias("brier_after"))
    return stats.withColumn("improvement", F.col("brier_before") - F.col("brier_after"))


def calibration_table(df: DataFrame, order: Sequence[str], label: str, raw: str, calibrated: str,
                      n: int = 10) -> DataFrame:
    """The first n rows of actual class, raw and calibrated probability and their difference."""
    return (df.orderBy(*[as_column(c) for c in order]).limit(n)
            .select(*[as_column(c) for c in order], as_column(label).alias("actual"), F.round(raw, 4).alias("raw"),
                    F.round(calibrated, 4).alias("calibrated"),
                    F.round(as_column(calibrated) - as_column(raw), 4).alias("diff")))


def model_comparison(results: DataFrame, rmse: str = "rmse") -> DataFrame:
    """Result rows with the RMSE as a share of the largest one."""
    top = one_row(results.agg(F.max(rmse).alias("top")))
    return (results.withColumn("_t", top)
            .withColumn("normalized_rmse", F.col(rmse) / F.when(F.col("_t.top") != 0, F.col("_t.top"))).drop("_t"))


# ---- clusters ---------------------------------------------------------------

def calinski_harabasz(df: DataFrame, features: Sequence[str], label: str, noise: int | None = -1) -> DataFrame:
    """Between/within variance ratio from per-cluster counts, means and variances; 0 below two clusters."""
    rows = df if noise is None else df.where(as_column(label) != noise)
    per = rows.groupBy(as_column(label).alias("_c")).agg(
        F.count("*").alias("_n"),
        *[F.avg(as_column(f)).alias(f"_m{i}") for i, f in enumerate(features)],
        *[F.var_pop(as_column(f)).alias(f"_v{i}") for i, f in enumerate(features)])
    spread = F.lit(0.0)
    for i, _ in enumerate(features):
        spread = spread + F.col(f"_v{i}")
    whole = [F.sum(F.col("_n") * F.col(f"_m{i}")).alias(f"_s{i}") for i, _ in enumerate(features)]
    square = F.lit(0.0)
    for i, _ in enumerate(features):
        square = square + F.col(f"_m{i}") * F.col(f"_m{i}")
    stats = per.agg(F.count("*").alias("clusters"), F.sum("_n").alias("rows"),
                    F.sum(F.col("_n") * spread).alias("_within"), F.sum(F.col("_n") * square).alias("_squares"), *whole)
    centre = F.lit(0.0)
    for i, _ in enumerate(features):
        centre = centre + F.col(f"_s{i}") * F.col(f"_s{i}")
    between = F.col("_squares") - centre / F.col("rows")
    k, n = F.col("clusters"), F.col("rows")
    usable = (k > 1) & (n > k) & (F.col("_within") > 0)
    value = (between / (k - 1)) / (F.col("_within") / (n - k))
    return stats.select("clusters", "rows", F.when(usable, value).otherwise(0.0).alias("calinski_harabasz"))


def _distance_sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Per point of ``left`` and cluster of ``right``: weighted sum of distances and of weights."""
    if left.empty or right.empty:
        return pd.DataFrame({"point": [], "own": [], "weight": [], "cluster": [], "total": [], "mass": []})
    a, b = np.array(left["v"].tolist()), np.array(right["v"].tolist())
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    near = square < 1e-6 * ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :])
    i, j = np.nonzero(near)
    square[i, j] = ((a[i] - b[j]) ** 2).sum(1)  # cancellation: redo close pairs directly
    distance = np.sqrt(np.maximum(square, 0.0))
    parts = []
    for cluster in np.unique(right["own"].to_numpy()):
        chosen = (right["own"] == cluster).to_numpy()
        w = right["weight"].to_numpy()[chosen].astype(float)
        parts.append(pd.DataFrame({"point": left["point"].to_numpy(), "own": left["own"].to_numpy(),
                                   "weight": left["weight"].to_numpy(), "cluster": cluster,
                                   "total": distance[:, chosen] @ w, "mass": w.sum()}))
    return pd.concat(parts)


def silhouette(df: DataFrame, features: Sequence[str], label: str, noise: int | None = -1,
               mode: str = "exact", block_rows: int = 2048) -> DataFrame:
    """Mean silhouette of all rows, 0 below two clusters.

    ``exact`` is Euclidean and compares every block of distinct points with every other:
    quadratic work by definition, in bounded tasks that return only one distance sum per
    point and cluster. ``squared`` is the built-in evaluator on squared distances, linear
    in the rows: the choice for big tables. Counts the distinct points first.
    """
    rows = df if noise is None else df.where(as_column(label) != noise)
    if mode == "squared":
        frame = VectorAssembler(inputCols=list(features), outputCol="_v").transform(rows)
        several = rows.agg((F.min(as_column(label)) < F.max(as_column(label))).alias("s")).first()["s"]
        value = ClusteringEvaluator(featuresCol="_v", predictionCol=label).evaluate(frame) if several else 0.0
        return frame.sparkSession.createDataFrame([(float(value),)], "silhouette double")
    vector = F.array(*[as_column(f).cast("double") for f in features])
    points = (rows.groupBy(vector.alias("v"), as_column(label).cast("long").alias("own"))
              .agg(F.count("*").cast("long").alias("weight"))
              .withColumn("point", F.md5(F.concat_ws(",", F.to_json("v"), "own"))))
    n = points.count()
    blocks = max(1, math.ceil(n / block_rows))
    points = points.withColumn("block", F.pmod(F.xxhash64("point"), F.lit(blocks)))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = points.withColumn("a", F.col("block").cast("int")).withColumn("b", every)
    right = points.withColumn("b", F.col("block").cast("int")).withColumn("a", every)
    sums = (left.groupBy("a", "b").cogroup(right.groupBy("a", "b"))
            .applyInPandas(_distance_sums, "point string, own long, weight long, cluster long, total double, mass double"))
    per = sums.groupBy("point", "own", "weight", "cluster").agg(F.sum("total").alias("t"), F.sum("mass").alias("m"))
    same = F.col("cluster") == F.col("own")
    scored = per.groupBy("point", "weight").agg(
        F.max(F.when(same, F.col("m"))).alias("own_n"), F.max(F.when(same, F.col("t"))).alias("own_t"),
        F.min(F.when(~same, F.col("t") / F.col("m"))).alias("b"))
    a = F.col("own_t") / F.when(F.col("own_n") > 1, F.col("own_n") - 1)
    s = F.when((F.col("own_n") > 1) & (F.greatest(a, F.col("b")) > 0), (F.col("b") - a) / F.greatest(a, F.col("b"))).otherwise(0.0)
    total = F.sum("weight")
    return (scored.agg(F.sum(s * F.col("weight")).alias("_s"), total.alias("_w"), F.count("b").alias("_k"))
            .select(F.when(F.col("_k") > 0, F.col("_s") / F.col("_w")).otherwise(0.0).alias("silhouette")))


def cluster_metrics(df: DataFrame, features: Sequence[str], label: str, noise: int | None = -1,
                    mode: str = "exact") -> DataFrame:
    """Silhouette and Calinski-Harabasz without noise rows, both 0 below two clusters."""
    ch = calinski_harabasz(df, features, label, noise)
    return (ch.withColumn("_s", one_row(silhouette(df, features, label, noise, mode)))
            .withColumn("silhouette", F.col("_s.silhouette")).drop("_s"))
