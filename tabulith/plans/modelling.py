"""Fit and score families of models on one prepared table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import boosting, linear, trees
from ..operators.columns import filter_not_null
from ..operators.metrics import classification_metrics, regression_metrics
from ..operators.prep import fit_preprocessor, slot_names, transform_data
from ..operators.splits import part_of, stratified_split, train_test_split
from ..operators.windows import union_results
from ..runtime import reused, write_out


def _encoded_parts(df: DataFrame, ids: Sequence[str], label: str, features: Sequence[str], stratify: bool,
                   test_size: float, seed: int) -> DataFrame:
    """Split rows with a label, fit the encoder on the training part, encode both: ids, label, features, part."""
    rows = filter_not_null(df, [label])
    parts = stratified_split(rows, label, ids, test_size, seed) if stratify else train_test_split(rows, ids, test_size, seed)
    parts = write_out(parts, "parts")  # each statistic of the encoder reads them
    model = fit_preprocessor(part_of(parts, "train"), features)
    kept = parts if label not in features else parts.withColumn("_label", F.col(label))
    encoded = transform_data(model, kept, features)
    return encoded.select(*ids, F.col("_label" if label in features else label).cast("double").alias("label"), "features", "part")


def run_supervised(df: DataFrame, ids: Sequence[str], features: Sequence[str], regression_target: str | None = None,
                   class_target: str | None = None, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """One result row per linear model: regressors on one target, logistic models on the other."""
    tables = []
    if regression_target:
        with reused(_encoded_parts(df, ids, regression_target, features, False, test_size, seed)) as parts:
            train, test = part_of(parts, "train"), part_of(parts, "test")
            for name, fit in (("Linear Regression", linear.linear_regression), ("Ridge Regression", linear.ridge),
                              ("Lasso Regression", linear.lasso), ("Elastic Net", linear.elastic_net)):
                scored = linear.predict(fit(train, "label"), test)
                row = regression_metrics(scored, "label", "prediction").first().asDict()
                tables.append(_result_row(df, name, "regression", row))
    if class_target:
        with reused(_encoded_parts(df, ids, class_target, features, True, test_size, seed)) as parts:
            train, test = part_of(parts, "train"), part_of(parts, "test")
            for name, fit in (("Logistic Regression", linear.logistic), ("Ridge Logistic Regression", linear.ridge_logistic)):
                scored = linear.predict(fit(train, "label"), test)
                row = classification_metrics(scored, "label", "prediction", "score").first().asDict()
                tables.append(_result_row(df, name, "classification", row))
    return union_results(*tables)


def _result_row(df: DataFrame, name: str, task: str, values: Mapping[str, float]) -> DataFrame:
    schema = "model string, task string, " + ", ".join(f"{k} double" for k in values)
    return df.sparkSession.createDataFrame([(name, task, *[float(v) for v in values.values()])], schema)


def run_trees(df: DataFrame, ids: Sequence[str], features: Sequence[str], target: str, test_size: float = 0.2, seed: int = 42,
              sizes: Mapping[str, int] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Six tree models on one stratified split: (metric rows, importance table per model).

    ``sizes`` overrides the number of trees per model.
    """
    size = {"Random Forest": 200, "AdaBoost": 150, "Gradient Boosting": 150, "XGBoost": 200, "LightGBM": 200, **(sizes or {})}
    rows, importances = [], {}
    with reused(_encoded_parts(df, ids, target, features, True, test_size, seed)) as parts:
        names = slot_names(parts)
        columns = [f"s{i}" for i, _ in enumerate(names)]
        train, test = part_of(parts, "train"), part_of(parts, "test")
        wide = boosting.expand_vector(train, "features", columns)
        models = {
            "Decision Tree": lambda: trees.decision_tree(train, "label"),
            "Random Forest": lambda: trees.random_forest(train, "label", trees=size["Random Forest"]),
            "AdaBoost": lambda: boosting.adaboost(wide, "label", columns, size["AdaBoost"]),
            "Gradient Boosting": lambda: trees.gradient_boosting(train, "label", trees=size["Gradient Boosting"]),
            "XGBoost": lambda: boosting.newton_boost(wide, "label", columns, ids, size["XGBoost"]),
            "LightGBM": lambda: boosting.newton_boost(wide, "label", columns, ids, size["LightGBM"], growth="leaf", lam=0.0,
                                                      min_weight=1e-3, min_rows=20, subsample=1.0),
        }
        for name, make in models.items():
            model = make()
            if isinstance(model, boosting.TreeEnsemble):
                scored = model.transform(boosting.expand_vector(test, "features", columns))
                kind = "splits" if name == "LightGBM" else "gain"
                table = model.feature_importance(df, kind)
                lookup = F.create_map(*[F.lit(x) for pair in zip(columns, names) for x in pair])
                importances[name] = table.withColumn("feature", lookup[F.col("feature")])
            else:
                scored = linear.predict(model, test)
                importances[name] = trees.feature_importance(model, df, names)
            values = classification_metrics(scored, "label", "prediction", "score").first().asDict()
            rows.append(_result_row(df, name, "classification", values))
    return union_results(*rows), importances
