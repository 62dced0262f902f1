"""Unsupervised chain and validation chain over one prepared table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clustering, manifold, search
from ..operators.joins import attach_by_id
from ..operators.metrics import cluster_metrics, roc_auc, roc_curve, youden_threshold
from ..operators.prep import prepare_numeric
from ..operators.reduction import pca, pca_reduce
from ..operators.windows import union_results
from ..runtime import reused, small_frame


def run_unsupervised(df: DataFrame, key: str, targets: Sequence[str] = (), k: int = 3, eps: float = 0.8, min_samples: int = 10,
                     n_init: int = 10, layouts: Mapping[str, int] | None = None, silhouette: str = "squared",
                     seed: int = 42) -> dict[str, DataFrame]:
    """Scale, reduce, cluster four ways and lay out: result tables by name.

    ``layouts`` gives the epochs per method (umap, tsne); an empty mapping skips them. A
    layout that fails is recorded in the summary instead of ending the run.
    """
    prepared, features = prepare_numeric(df, targets, [key])
    out: dict[str, DataFrame] = {}
    rows = []
    with reused(prepared) as frame:
        found = pca(frame, features, scaled=True)
        out["pca_variance"], out["pca_loadings"] = found.variance_table(df), found.loadings_table(df)
        out["projection"] = found.transform(frame, scaled=True).select(key, *[f"PC{i + 1}" for i in range(min(2, found.kept))])

        def record(name, labels, inertia=None):
            metrics = cluster_metrics(labels, features, "cluster", mode=silhouette).first()
            rows.append((name, int(metrics["clusters"]), inertia, float(metrics["silhouette"]), float(metrics["calinski_harabasz"])))
            out[f"{name}_distribution"] = clustering.cluster_distribution(labels, "cluster")
            out[f"{name}_labels"] = labels.select(key, "cluster")

        labels, _, inertia = clustering.kmeans(frame, features, k, n_init=n_init, seed=seed)
        record("kmeans", labels, inertia)
        labels, _, inertia = clustering.kmeans_pp(frame, features, k, n_init=n_init, seed=seed)
        record("kmeans_pp", labels, inertia)
        labels, out["dendrogram"] = clustering.hierarchical(frame, features, k, seed=seed)
        record("hierarchical", labels)
        record("dbscan", clustering.dbscan(frame, key, features, eps, min_samples))

        runs = []
        reduced, columns = pca_reduce(frame, features)
        vectors = reduced.select(F.col(key), F.array(*[F.col(c) for c in columns]).alias("v"))
        count = frame.count()
        for name, epochs in (layouts or {}).items():
            for dims in (2, 3):
                try:
                    if name == "umap":
                        layout = manifold.umap_layout(vectors, key, "v", dims, epochs=epochs)
                    else:
                        layout = manifold.tsne_layout(vectors, key, "v", dims, iterations=epochs, exaggerated=epochs // 4)
                    out[f"{name}_{dims}d"] = attach_by_id(layout.withColumnRenamed("id", key), out["kmeans_labels"], key)
                    runs.append((name, count, dims, "completed"))
                except Exception as error:  # noqa: BLE001 - a failed layout is a result row
                    runs.append((name, count, dims, f"failed: {error}"))
        out["manifold_summary"] = manifold.manifold_summary(df.sparkSession, runs)
    out["results"] = small_frame(df.sparkSession, rows, "algorithm string, clusters int, inertia double, silhouette double, "
                                                        "calinski_harabasz double")
    return out


def run_validation(df: DataFrame, ids: Sequence[str], label: str, features: str, grid: Mapping[str, Sequence],
                   choices: Mapping[str, object], n_iter: int = 20, k: int = 5, seed: int = 42,
                   parallelism: int = 4) -> dict[str, DataFrame]:
    """Holdout, k-fold, calibration, ROC analysis and the three searches on the whole table."""
    out = {}
    with reused(df) as rows:
        out["holdout"] = search.holdout_validate(rows, ids, label, features, seed=seed)
        out["folds"] = search.cross_validate(rows, ids, label, features, k, seed, parallelism=parallelism)
        with reused(search.platt_calibrate(rows, ids, label, features, k=k, seed=seed)) as calibrated:
            out["calibration"] = small_frame(df.sparkSession, [tuple(search.calibration_report(calibrated, label).first())],
                                             "brier_before double, brier_after double, improvement double")
            out["roc"] = small_frame(df.sparkSession, [(
                roc_auc(calibrated, label, "raw", 1.0).first()[0], youden_threshold(calibrated, label, "raw").first()[0])],
                "roc_auc double, threshold double")
            points = roc_curve(calibrated, label, "raw").orderBy(F.desc("threshold")).limit(8)
            out["roc_points"] = small_frame(df.sparkSession, [tuple(r) for r in points.collect()],
                                            "threshold double, fpr double, tpr double")
        shared = dict(features=features, k=k, seed=seed, parallelism=parallelism)
        runs = {
            "grid": search.grid_search_cv(rows, ids, label, grid, **shared),
            "random": search.random_search_cv(rows, ids, label, choices, n_iter, **shared),
            "bayesian": search.bayesian_search_cv(rows, ids, label, grid, n_iter, **shared),
        }
    out |= {f"{name}_trials": table for name, table in runs.items()}
    named = [t.select(F.lit(n).alias("method"), "trial", "mean_score") for n, t in runs.items()]
    out["convergence"] = search.convergence(union_results(*named))
    out["search_summary"] = search.search_summary(df.sparkSession, runs, k)
    return out
