"""Linear and logistic models, with penalties stated the usual way (alpha, C)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import small_frame


def _linear(features: str, label: str, reg: float, mix: float, max_iter: int) -> LinearRegression:
    # penalties below are stated on the raw coefficients, hence standardization off; "auto" solves the normal
    # equations in one pass over the rows up to the width Spark allows, and descends beyond, to the same optimum
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=mix,
                            standardization=False, solver="auto", maxIter=max_iter, tol=1e-12)


def _rows_and_spread(train: DataFrame, label: str) -> tuple[int, float]:
    row = train.agg(F.count(as_column(label)).alias("n"), F.stddev_pop(as_column(label)).alias("s")).first()
    return row["n"], float(row["s"] or 1.0)


def linear_regression(train: DataFrame, label: str, features: str = "features", max_iter: int = 500):
    """Ordinary least squares."""
    return _linear(features, label, 0.0, 0.0, max_iter).fit(train)


def ridge(train: DataFrame, label: str, features: str = "features", alpha: float = 1.0, max_iter: int = 500):
    """Least squares of sum (y - xw)^2 + alpha * |w|^2."""
    n, spread = _rows_and_spread(train, label)  # Spark minimises on y / std(y), averaged over rows
    return _linear(features, label, alpha * spread / n, 0.0, max_iter).fit(train)


@dataclass
class LinearModel:
    """Coefficients over a vector column; ``transform`` adds ``prediction``."""

    coefficients: DenseVector
    intercept: float
    features: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        products = F.zip_with(vector_to_array(self.features), weights, lambda x, w: x * w)
        return df.withColumn("prediction", F.aggregate(products, F.lit(float(self.intercept)), lambda a, v: a + v))


def _gram(train: DataFrame, label: str, features: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, means, deviations, mean products of the standardised slots, the label as the last slot).

    Two readings: moments, then block products summed in Arrow batches and merged by key. Rows without a label stay out.
    """
    rows = train.where(as_column(label).isNotNull()).select(F.col(features).alias("v"), as_column(label).cast("double").alias("y"))
    moments = rows.agg(Summarizer.metrics("mean", "std", "count").summary(F.col("v")).alias("v"), F.avg("y").alias("m"),
                       F.stddev_pop("y").alias("s")).first()
    n = int(moments["v"]["count"])
    mean = np.append(moments["v"]["mean"].toArray(), moments["m"])
    spread = np.append(moments["v"]["std"].toArray(), moments["s"])
    spread[spread == 0] = 1.0
    width = len(mean)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            slots = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width - 1)
            z = (np.column_stack([slots, batch.column(1).to_numpy()]) - mean) / spread
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)),
                                          pa.array(total.tolist(), pa.list_(pa.float64()))], ["slot", "sums"])
    parts = rows.select(vector_to_array("v").alias("v"), "y").mapInArrow(products, "slot int, sums array<double>")
    summed = (parts.select("slot", F.posexplode("sums").alias("other", "s")).groupBy("slot", "other").agg(F.sum("s").alias("s"))
              .toArrow())
    gram = np.zeros((width, width))
    gram[summed.column("slot").to_numpy(), summed.column("other").to_numpy()] = summed.column("s").to_numpy()
    return n, mean, spread, gram / n


def _descend(gram: np.ndarray, one: np.ndarray, two: np.ndarray, max_iter: int, tolerance: float = 1e-14) -> np.ndarray:
    """Minimiser of w G w / 2 - w g + sum(one |w|) + sum(two w^2) / 2 by coordinate descent with covariance updates.

    ``gram`` holds G and, as its last column, g. Ends when a full round moves no slope by more than the tolerance.
    """
    d = len(gram) - 1
    square, slope = gram[:d, :d], gram[:d, d].copy()  # slope = g - G w
    w = np.zeros(d)
    for _ in range(max_iter):
        moved = 0.0
        for j in range(d):
            if square[j, j] <= 0:
                continue
            pull = slope[j] + square[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - one[j], 0.0) / (square[j, j] + two[j])
            step = new - w[j]
            if step:
                slope -= square[:, j] * step
                w[j] = new
                moved = max(moved, abs(step) * square[j, j])
        if moved <= tolerance:
            break
    return w


MAX_GRAM = 2048  # slots whose products are gathered; wider vectors are fitted by gradients, summed over a tree of tasks


def _penalised(train: DataFrame, label: str, features: str, one: float, two: float, max_iter: int) -> LinearModel | None:
    """Exact minimiser of mean squared error / 2 + one * |w|_1 + two / 2 * |w|^2, or None for vectors too wide for it."""
    first = train.select(features).first()
    if first is None or first[0] is None or first[0].size > MAX_GRAM:
        return None
    _, mean, spread, gram = _gram(train, label, features)
    x, y = spread[:-1], spread[-1]
    # in standardised slots v = w x / y, so that penalties on w become penalties on v by slot
    v = _descend(gram, one / (x * y), two / (x * x), max_iter)
    w = v * y / x
    return LinearModel(DenseVector(w), float(mean[-1] - w @ mean[:-1]), features)


def lasso(train: DataFrame, label: str, features: str = "features", alpha: float = 0.001, max_iter: int = 10_000):
    """Least squares of mean squared error / 2 + alpha * |w|_1."""
    return (_penalised(train, label, features, alpha, 0.0, max_iter)
            or _linear(features, label, alpha, 1.0, max_iter).fit(train))


def elastic_net(train: DataFrame, label: str, features: str = "features", alpha: float = 0.001,
                l1_ratio: float = 0.5, max_iter: int = 10_000):
    """Least squares of mean squared error / 2 + alpha * (l1_ratio * |w|_1 + (1 - l1_ratio) / 2 * |w|^2)."""
    found = _penalised(train, label, features, alpha * l1_ratio, alpha * (1.0 - l1_ratio), max_iter)
    if found:
        return found
    _, spread = _rows_and_spread(train, label)
    one, two = alpha * l1_ratio, alpha * (1.0 - l1_ratio) * spread
    total = one + two
    return _linear(features, label, total, one / total if total else 0.0, max_iter).fit(train)


def logistic(train: DataFrame, label: str, features: str = "features", max_iter: int = 1000):
    """Logistic regression without penalty."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=0.0, standardization=False,
                              maxIter=max_iter, tol=1e-6).fit(train)


def ridge_logistic(train: DataFrame, label: str, features: str = "features", c: float = 1.0, max_iter: int = 1000):
    """Logistic regression with penalty |w|^2 / 2 against c times the summed loss."""
    n, _ = _rows_and_spread(train, label)
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, tol=1e-8).fit(train)


def predict(model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``prediction`` and, for classifiers, ``score`` = probability of class 1.

    The predicted class is 1 where the score exceeds the threshold.
    """
    scored = model.transform(df)
    if "probability" not in scored.columns:
        return scored
    scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("prediction", (F.col("score") > threshold).cast("double"))


def coefficients(model, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, coefficient), the intercept last."""
    rows = [(n, float(v)) for n, v in zip(names, model.coefficients, strict=True)]
    return small_frame(df.sparkSession, [*rows, ("intercept", float(model.intercept))], "feature string, coefficient double")
