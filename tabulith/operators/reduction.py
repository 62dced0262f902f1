"""Principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import one_row, small_frame
from .prep import scale_columns
from .statistics import covariance_2x2
from .windows import first_at_least, running_sum


@dataclass
class Components:
    """Fitted components: loadings (features x components) and explained variance shares."""

    features: list[str]
    loadings: np.ndarray
    shares: list[float]
    kept: int
    model: PCAModel
    signs: np.ndarray

    def transform(self, df: DataFrame, prefix: str = "PC", scaled: bool = False) -> DataFrame:
        """Add PC1..PCk. ``df`` is standardised first unless ``scaled``."""
        frame = df if scaled else scale_columns(df, self.features)
        vector = F.array(*[as_column(f).cast("double") for f in self.features])
        moved = self.model.transform(frame.withColumn("_v", array_to_vector(vector))).withColumn("_p", vector_to_array("_p"))
        return moved.withColumns({f"{prefix}{j + 1}": F.col("_p")[j] * F.lit(float(self.signs[j]))
                                  for j in range(self.kept)}).drop("_v", "_p")

    def variance_table(self, df: DataFrame) -> DataFrame:
        rows = [(j + 1, float(s)) for j, s in enumerate(self.shares)]
        table = small_frame(df.sparkSession, rows, "component int, explained_variance double")
        return running_sum(table, "component", "explained_variance", out="cumulative_variance")

    def loadings_table(self, df: DataFrame) -> DataFrame:
        rows = [(f, j + 1, float(self.loadings[i, j])) for i, f in enumerate(self.features) for j in range(self.kept)]
        return small_frame(df.sparkSession, rows, "feature string, component int, loading double")


def pca(df: DataFrame, features: Sequence[str], variance: float | None = 0.95, k: int | None = None,
        scaled: bool = False) -> Components:
    """Components of the standardised columns: the fewest that keep ``variance``, or exactly ``k``.

    One distributed pass for the d x d covariance matrix; its decomposition is d-sized. The
    sign of a component makes its largest loading positive.
    """
    frame = df if scaled else scale_columns(df, features)
    frame = frame.select(array_to_vector(F.array(*[as_column(f).cast("double") for f in features])).alias("_v"))
    model = PCA(k=len(features), inputCol="_v", outputCol="_p").fit(frame)
    loadings = model.pc.toArray()
    top = np.abs(loadings).argmax(0)
    signs = np.where(loadings[top, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)
    loadings = loadings * signs
    shares = [float(s) for s in model.explainedVariance]
    if k is None:
        table = Components(list(features), loadings, shares, 0, model, signs).variance_table(df)
        # a rounding error must not ask for one component more than exist
        found = first_at_least(table, "component", "cumulative_variance", variance - 1e-12).first()[0]
        k = found or len(features)
    return Components(list(features), loadings, shares, min(k, len(features)), model, signs)


def pca_reduce(df: DataFrame, features: Sequence[str], dim: int = 30) -> tuple[DataFrame, list[str]]:
    """At most ``dim`` components; frames that are already that narrow are returned as they are."""
    if len(features) <= dim:
        return df, list(features)
    found = pca(df, features, variance=None, k=dim, scaled=True)
    return found.transform(df, scaled=True), [f"PC{i + 1}" for i in range(dim)]


def pca_2col(df: DataFrame, a: str, b: str, keep: Sequence[str] = ()) -> DataFrame:
    """Both components of two raw columns in closed form: keep..., pc1, pc2, share1, share2 per row."""
    frame = df.withColumn("_m", one_row(covariance_2x2(df, a, b)))
    va, vb, cov = F.col("_m.var_a"), F.col("_m.var_b"), F.col("_m.cov_ab")
    half = F.sqrt((va - vb) * (va - vb) / 4 + cov * cov)
    first, second = (va + vb) / 2 + half, (va + vb) / 2 - half
    # eigenvector of the larger root; the axis itself when the columns are uncorrelated
    vx = F.when(cov != 0, first - vb).otherwise(F.when(va >= vb, 1.0).otherwise(0.0))
    vy = F.when(cov != 0, cov).otherwise(F.when(va >= vb, 0.0).otherwise(1.0))
    length = F.sqrt(vx * vx + vy * vy)
    flip = F.when(F.abs(vx) >= F.abs(vy), F.signum(vx)).otherwise(F.signum(vy))
    ux, uy = vx / length * flip, vy / length * flip
    # the second axis is perpendicular, its larger loading positive as well
    flip2 = F.when(F.abs(uy) >= F.abs(ux), F.signum(-uy)).otherwise(F.signum(ux))
    x, y = as_column(a) - F.col("_m.mean_a"), as_column(b) - F.col("_m.mean_b")
    return frame.where(as_column(a).isNotNull() & as_column(b).isNotNull()).select(
        *[as_column(c) for c in keep], (x * ux + y * uy).alias("pc1"), ((-x * uy + y * ux) * flip2).alias("pc2"),
        (first / (first + second)).alias("share1"), (second / (first + second)).alias("share2"))
