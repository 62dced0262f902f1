"""Validation, calibration and hyper-parameter search by real cross-validation."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import as_column, expected_improvement
from ..runtime import reused, small_frame
from .histogram_forest import Limits, grow_many
from .joins import cross_grid
from .linear import predict
from .metrics import brier_score, classification_metrics
from .ordering import hash_uniform
from .splits import kfold, part_of, stratified_split, train_test_split
from .trees import random_forest
from .windows import arg_best, running_max, union_results

Fit = Callable[[DataFrame, Mapping[str, float]], object]


FOREST_PARAMS = {"trees": 50, "depth": 5, "min_leaf": 1, "min_split": 2}


def forest_fit(label: str, features: str = "features", seed: int = 42) -> Fit:
    """Fit function for a random forest with parameters trees, depth, min_leaf and min_split.

    Its ``many`` scores several parameter rows at once: forests of one ``min_leaf`` are cuts of one, which is grown, scored in one
    reading of the test rows and dropped before the next. A tree is grown as far as a trial that counts it in needs. Same results as
    separate fits. ``kept`` holds grown forests by ``min_leaf`` between calls for the same rows; one that a trial is no cut of is
    grown anew, so large that the trials before are cuts of it, too.
    """
    def full(params: Mapping[str, float]) -> dict[str, int]:
        if unknown := set(params) - set(FOREST_PARAMS):
            raise ValueError(f"unknown parameters {sorted(unknown)}; the forest takes {', '.join(FOREST_PARAMS)}")
        return {n: int(params.get(n, v)) for n, v in FOREST_PARAMS.items()}

    def fit(train: DataFrame, params: Mapping[str, float]):
        return random_forest(train, label, features, seed=seed, **full(params))

    def many(train: DataFrame, test: DataFrame, trials: Sequence[Mapping[str, float]], kept: dict | None = None) -> list[float]:
        rows = [full(t) for t in trials]
        groups: dict[int, list[int]] = {}
        for i, r in enumerate(rows):
            groups.setdefault(r["min_leaf"], []).append(i)
        scores = [0.0] * len(rows)
        for leaf, group in groups.items():
            limit = Limits(max(rows[i]["trees"] for i in group), max(rows[i]["depth"] for i in group),
                           min(rows[i]["min_split"] for i in group), leaf)
            cuts = [(rows[i]["trees"], rows[i]["depth"], rows[i]["min_split"]) for i in group]
            if kept is None:
                model = grow_many(train, label, [limit], features, seed=seed, cuts=[cuts])[0]
            else:
                grown, model = kept.get(leaf, (limit, None))
                whole = Limits(max(grown.trees, limit.trees), max(grown.depth, limit.depth), min(grown.min_split, limit.min_split), leaf)
                if model is None or whole != grown:
                    model = grow_many(train, label, [whole], features, seed=seed)[0]
                    kept[leaf] = whole, model
            found = model.accuracies(test, label, cuts)
            for i, score in zip(group, found):
                scores[i] = score
        return scores

    fit.many = many
    return fit


def accuracy(df: DataFrame, label: str) -> float:
    row = df.agg(F.avg((as_column("prediction") == as_column(label)).cast("double")).alias("a")).first()
    return float(row["a"] or 0.0)


# ---- validation -------------------------------------------------------------

def holdout_validate(df: DataFrame, ids: Sequence[str], label: str, features: str = "features", test_size: float = 0.2,
                     seed: int = 42, fit: Fit | None = None) -> DataFrame:
    """One row: sizes, accuracy on both parts, and precision, recall, f1, roc_auc on the test part."""
    fit = fit or forest_fit(label, features, seed)
    with reused(stratified_split(df, label, ids, test_size, seed)) as parts:
        train, test = part_of(parts, "train"), part_of(parts, "test")
        model = fit(train, {"trees": 50, "depth": 5})
        seen = accuracy(predict(model, train), label)
        row = classification_metrics(predict(model, test), label, "prediction", "score", single_class=1.0).first()
        sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    return small_frame(df.sparkSession, [(
        sizes.get("train", 0), sizes.get("test", 0), seen, row["accuracy"], row["precision"], row["recall"], row["f1"],
        row["roc_auc"])], "train_rows long, test_rows long, train_accuracy double, test_accuracy double, "
                          "precision double, recall double, f1 double, roc_auc double")


def fold_scores(folded: DataFrame, label: str, fit: Fit, trials: Sequence[Mapping[str, float]], k: int,
                parallelism: int = 4, kept: Mapping[int, dict] | None = None) -> dict[tuple[int, int], float]:
    """Accuracy of every (trial, fold); several fits are in flight at once so that executors stay busy.

    ``kept`` has a dict per fold for what ``fit.many`` grows, for further calls on the same folds.
    """
    many = getattr(fit, "many", None)

    def run(task):
        batch, fold = task
        train, test = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        found = (many(train, test, [trials[t] for t in batch], *([kept[fold]] if kept else [])) if many else
                 [accuracy(fit(train, trials[t]).transform(test), label) for t in batch])
        return [((t, fold), score) for t, score in zip(batch, found)]

    batches = [range(len(trials))] if many else [[t] for t, _ in enumerate(trials)]
    with ThreadPoolExecutor(parallelism) as pool:
        return dict(itertools.chain.from_iterable(pool.map(run, itertools.product(batches, range(k)))))


def cross_validate(df: DataFrame, ids: Sequence[str], label: str, features: str = "features", k: int = 5, seed: int = 42,
                   fit: Fit | None = None, parallelism: int = 4) -> DataFrame:
    """Per fold: train and test rows and accuracy; the mean and population deviation on every row."""
    fit = fit or forest_fit(label, features, seed)
    with reused(kfold(df, ids, k, seed)) as folded:
        scores = fold_scores(folded, label, fit, [{"trees": 50, "depth": 5}], k, parallelism)
        sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    total = sum(sizes.values())
    values = [scores[0, f] for f in range(k)]
    rows = [(f, total - sizes.get(f, 0), sizes.get(f, 0), values[f], float(np.mean(values)), float(np.std(values)))
            for f in range(k)]
    return small_frame(df.sparkSession, rows, "fold int, train_rows long, test_rows long, accuracy double, "
                                              "mean_accuracy double, std_accuracy double")


# ---- calibration ------------------------------------------------------------

def platt_sigmoid(scored: DataFrame, label: str, score: str) -> tuple[float, float]:
    """(slope, intercept) of the sigmoid through (score, smoothed class).

    Platt's targets are (p + 1) / (p + 2) and 1 / (n + 2); each row enters once per class with
    the target as its weight, which is the same likelihood.
    """
    y = as_column(label) == 1
    row = scored.agg(F.count(F.when(y, 1)).alias("p"), F.count(F.when(~y, 1)).alias("n")).first()
    high, low = (row["p"] + 1.0) / (row["p"] + 2.0), 1.0 / (row["n"] + 2.0)
    target = F.when(y, F.lit(high)).otherwise(F.lit(low))
    rows = scored.select(as_column(score).alias("s"), F.inline(F.array(
        F.struct(F.lit(1.0).alias("y"), target.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w")))))
    rows = VectorAssembler(inputCols=["s"], outputCol="v").transform(rows)
    model = LogisticRegression(featuresCol="v", labelCol="y", weightCol="w", standardization=False, maxIter=200,
                               tol=1e-10).fit(rows)
    return float(model.coefficients[0]), float(model.intercept)


def platt_calibrate(df: DataFrame, ids: Sequence[str], label: str, features: str = "features", test_size: float = 0.3,
                    k: int = 5, seed: int = 42, fit: Fit | None = None) -> DataFrame:
    """Test rows with ``raw`` (one model on all training rows) and ``calibrated`` probability.

    The latter is the mean over k folds (each with its share of every class) of a model fitted without
    the fold, passed through the sigmoid fitted on that fold.
    """
    fit = fit or forest_fit(label, features, seed)
    params = {"trees": 50, "depth": 5}
    parts = train_test_split(df, ids, test_size, seed)
    train, test = part_of(parts, "train"), part_of(parts, "test")
    kept = [*ids, label, features]

    def score(model, rows, name):
        scored = predict(model, rows).withColumnRenamed("score", name)
        return scored.drop("prediction", "probability", "rawPrediction")

    with reused(kfold(train.select(*kept), ids, k, seed, by=[label])) as folded:
        scored = score(fit(folded, params), test.select(*kept), "raw")
        total = F.lit(0.0)
        for fold in range(k):
            model = fit(folded.where(F.col("fold") != fold), params)
            held = score(model, folded.where(F.col("fold") == fold), "_s")
            slope, intercept = platt_sigmoid(held, label, "_s")
            scored = score(model, scored, f"_s{fold}")
            total = total + 1.0 / (1.0 + F.exp(-(F.lit(slope) * F.col(f"_s{fold}") + F.lit(intercept))))
    return scored.withColumn("calibrated", total / k).select(*ids, label, "raw", "calibrated")


def calibration_report(calibrated: DataFrame, label: str) -> DataFrame:
    return brier_score(calibrated, label, "raw", "calibrated")


# ---- candidates -------------------------------------------------------------

def param_grid(spark: SparkSession, values: Mapping[str, Sequence]) -> DataFrame:
    return cross_grid(spark, values)


def random_candidates(spark: SparkSession, n: int, bounds: Mapping[str, object], seed: int = 42) -> DataFrame:
    """n draws: uniform within (low, high), or an element of a list. Draws depend on seed and trial only."""
    frame = spark.range(1, n + 1).select(F.col("id").cast("int").alias("trial"))
    for i, (name, bound) in enumerate(bounds.items()):
        u = hash_uniform(["trial"], seed * 1000 + i)
        if isinstance(bound, tuple):
            value = F.lit(float(bound[0])) + u * F.lit(float(bound[1]) - float(bound[0]))
        else:
            value = F.get(F.array(*[F.lit(v) for v in bound]), F.floor(u * len(bound)).cast("int"))
        frame = frame.withColumn(name, value)
    return frame


def surface(spark: SparkSession, x: tuple[float, float], y: tuple[float, float], expression: Callable[[Column, Column], Column],
            n: int = 50) -> DataFrame:
    """A column expression evaluated on an n x n mesh: (x, y, z)."""
    def axis(bound, i):
        return F.lit(float(bound[0])) + i * F.lit((float(bound[1]) - float(bound[0])) / (n - 1))
    cells = spark.range(n * n).select(axis(x, F.pmod("id", F.lit(n))).alias("x"), axis(y, F.floor(F.col("id") / n)).alias("y"))
    return cells.withColumn("z", expression(F.col("x"), F.col("y")))


# ---- searches ---------------------------------------------------------------

def trial_table(trials: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """Candidates with one column per fold (from 1) and the mean score, rounded to 4 places.

    ``scores`` has (trial, fold, score), folds from 0.
    """
    wide = scores.groupBy("trial").pivot("fold", list(range(k))).agg(F.avg("score"))
    mean = scores.groupBy("trial").agg(F.round(F.avg("score"), 4).alias("mean_score"))
    named = wide.select("trial", *[F.round(F.col(str(f)), 4).alias(f"fold_{f + 1}") for f in range(k)])
    return trials.join(mean, "trial").join(named, "trial")


def _search(df: DataFrame, ids, label, features, trials: DataFrame, names: Sequence[str], k: int, seed: int, fit: Fit | None,
            parallelism: int) -> DataFrame:
    fit = fit or forest_fit(label, features, seed)
    candidates = [r.asDict() for r in trials.orderBy("trial").collect()]  # one small row per trial
    with reused(kfold(df, ids, k, seed)) as folded:
        scores = fold_scores(folded, label, fit, [{n: c[n] for n in names} for c in candidates], k, parallelism)
    rows = [(candidates[t]["trial"], f, s) for (t, f), s in scores.items()]
    return trial_table(trials, small_frame(df.sparkSession, rows, "trial int, fold int, score double"), k)


def grid_search_cv(df: DataFrame, ids: Sequence[str], label: str, grid: Mapping[str, Sequence], features: str = "features",
                   k: int = 5, seed: int = 42, fit: Fit | None = None, parallelism: int = 4) -> DataFrame:
    """Every combination, scored by k-fold accuracy."""
    return _search(df, ids, label, features, param_grid(df.sparkSession, grid), list(grid), k, seed, fit, parallelism)


def random_search_cv(df: DataFrame, ids: Sequence[str], label: str, choices: Mapping[str, object], n_iter: int = 25,
                     features: str = "features", k: int = 5, seed: int = 42, fit: Fit | None = None,
                     parallelism: int = 4) -> DataFrame:
    """``n_iter`` random combinations, scored by k-fold accuracy."""
    trials = random_candidates(df.sparkSession, n_iter, choices, seed)
    return _search(df, ids, label, features, trials, list(choices), k, seed, fit, parallelism)


def _matern(a: np.ndarray, b: np.ndarray, length: float) -> np.ndarray:
    d = np.sqrt(np.maximum(((a[:, None, :] - b[None, :, :]) ** 2).sum(2), 0.0)) / length
    s = math.sqrt(5.0) * d
    return (1.0 + s + s * s / 3.0) * np.exp(-s)


def _posterior(x: np.ndarray, y: np.ndarray, noise: float = 1e-5):
    """Gaussian process on at most a few hundred trials; the length scale is the likeliest of a short list."""
    mean, spread = y.mean(), y.std() or 1.0
    target, best = (y - mean) / spread, None
    for length in (0.1, 0.2, 0.5, 1.0, 2.0):
        lower = np.linalg.cholesky(_matern(x, x, length) + noise * np.eye(len(x)))
        alpha = np.linalg.solve(lower.T, np.linalg.solve(lower, target))
        likelihood = -0.5 * target @ alpha - np.log(np.diag(lower)).sum()
        if best is None or likelihood > best[0]:
            best = (likelihood, length, lower, alpha)
    return best[1], best[2], best[3], mean, spread


def suggest(candidates: DataFrame, names: Sequence[str], tried: Sequence[Mapping[str, float]], scores: Sequence[float],
            xi: float = 0.01) -> DataFrame:
    """Candidates with predicted mean ``mu``, deviation ``sigma`` and expected improvement ``ei``."""
    ends = candidates.agg(*[F.min(n).cast("double").alias(f"lo{i}") for i, n in enumerate(names)],
                          *[F.max(n).cast("double").alias(f"hi{i}") for i, n in enumerate(names)]).first()
    low = np.array([ends[f"lo{i}"] for i, _ in enumerate(names)])
    span = np.array([(ends[f"hi{i}"] - ends[f"lo{i}"]) or 1.0 for i, _ in enumerate(names)])
    x = (np.array([[float(t[n]) for n in names] for t in tried]) - low) / span
    length, lower, alpha, mean, spread = _posterior(x, np.array(scores, dtype=float))

    @F.pandas_udf("struct<mu double, sigma double>")
    def posterior(values: pd.Series) -> pd.DataFrame:
        here = (np.array(values.tolist(), dtype=float).reshape(len(values), -1) - low) / span
        cross = _matern(here, x, length)
        mu = cross @ alpha * spread + mean
        half = np.linalg.solve(lower, cross.T)
        return pd.DataFrame({"mu": mu, "sigma": np.sqrt(np.maximum(1.0 - (half**2).sum(0), 0.0)) * spread})

    guessed = candidates.withColumn("_p", posterior(F.array(*[F.col(n).cast("double") for n in names])))
    return (guessed.withColumn("mu", F.col("_p.mu")).withColumn("sigma", F.col("_p.sigma")).drop("_p")
            .withColumn("ei", expected_improvement("mu", "sigma", F.lit(float(max(scores))), xi)))


def bayesian_search_cv(df: DataFrame, ids: Sequence[str], label: str, grid: Mapping[str, Sequence], n_iter: int = 20,
                       n_init: int = 5, features: str = "features", k: int = 5, seed: int = 42, fit: Fit | None = None,
                       parallelism: int = 4) -> DataFrame:
    """Random starts, then the candidate with the largest expected improvement each time."""
    fit = fit or forest_fit(label, features, seed)
    spark, names = df.sparkSession, list(grid)
    pool = param_grid(spark, grid)
    first = [r.asDict() for r in pool.orderBy(hash_uniform(["trial"], seed)).limit(min(n_init, n_iter)).collect()]
    tried, rows, means, guesses = [], [], [], []
    kept = {fold: {} for fold in range(k)}  # a later candidate is a cut of an earlier forest where it needs no more trees or levels

    def evaluate(batch):
        scores = fold_scores(folded, label, fit, [{n: c[n] for n in names} for c in batch], k, parallelism, kept)
        for t, candidate in enumerate(batch):
            number = len(tried) + 1
            tried.append(candidate)
            rows.extend((number, f, scores[t, f]) for f in range(k))
            means.append(float(np.mean([scores[t, f] for f in range(k)])))

    with reused(kfold(df, ids, k, seed)) as folded:
        evaluate(first)
        guesses += [(None, None, None)] * len(first)
        while len(tried) < n_iter:
            left = pool.where(~F.col("trial").isin([t["trial"] for t in tried]))
            best = arg_best(suggest(left, names, tried, means), "ei", "trial").first()
            if best is None or best["trial"] is None:
                break
            guesses.append((best["mu"], best["sigma"], best["ei"]))
            evaluate([{n: best[n] for n in ["trial", *names]}])
    kinds = dict(pool.dtypes)
    trials = small_frame(spark, [(i + 1, *[t[n] for n in names], *g) for i, (t, g) in enumerate(zip(tried, guesses))],
                         "trial int, " + ", ".join(f"{n} {kinds[n]}" for n in names) + ", mu double, sigma double, ei double")
    return trial_table(trials, small_frame(spark, rows, "trial int, fold int, score double"), k)


def best_trial(trials: DataFrame) -> DataFrame:
    return arg_best(trials, "mean_score", "trial")


def refit_best(df: DataFrame, trials: DataFrame, label: str, names: Sequence[str], features: str = "features", seed: int = 42,
               fit: Fit | None = None):
    """The model of the best trial's parameters ``names``, fitted on all rows."""
    fit = fit or forest_fit(label, features, seed)
    best = best_trial(trials).first()
    return fit(df, {n: best[n] for n in names})


def convergence(trials: DataFrame, method: str = "method") -> DataFrame:
    """Best score so far per method."""
    return running_max(trials, "trial", "mean_score", [method], "best_so_far")


def search_summary(spark: SparkSession, runs: Mapping[str, DataFrame], k: int) -> DataFrame:
    """One row per method: its best score, number of trials and folds."""
    tables = []
    for name, trials in runs.items():
        best = trials.agg(F.max("mean_score").alias("best_score"), F.count("*").alias("evaluations"))
        tables.append(best.select(F.lit(name).alias("method"), "best_score", "evaluations", F.lit(k).alias("folds")))
    return union_results(*tables)
