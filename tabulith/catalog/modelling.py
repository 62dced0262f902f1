"""Fitted models on whole tables. Results are iterative, so these have no SQL; tests check them against closed forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boosting, linear, prep, search, splits, trees
from ..operators.metrics import classification_metrics, regression_metrics
from ..plans import exploration, modelling
from ..runtime import reused, scratch_folder, small_frame, write_out
from ..sources import tables
from . import query, table
from .shared import SCORED, rounded

NUMBERS = ["n_chars", "words", "lines", "vowels"]
TEXTS = ["lang"]


def labelled_documents(spark, d):
    """Quality label and whole-text features of every labelled document, stored: encoders and splits read them several times."""
    docs = table(spark, d, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.size(F.split("text", " ")).alias("words"),
        F.size(F.split("text", "\n")).alias("lines"),
        (F.col("n_chars") - F.length(F.regexp_replace("text", "[aeiou]", ""))).alias("vowels"))
    return write_out(table(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id"), "labelled")


def encoded(spark, d):
    rows = labelled_documents(spark, d)
    model = prep.fit_preprocessor(rows, NUMBERS + TEXTS)
    return prep.transform_data(model, rows, NUMBERS + TEXTS).select("doc_id", F.col("quality").cast("double").alias("label"), "features")


def order_features(spark, d):
    """Order value and line aggregates, for regression: every order that has lines. Stored, as ``labelled_documents``."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"),
        F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"))
    return write_out(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").join(lines, "o_orderkey"), "order-features")


ORDER_FEATURES = ["lines", "quantity", "discount", "tax", "o_orderpriority"]


def encoded_orders(spark, d):
    rows = order_features(spark, d)
    model = prep.fit_preprocessor(rows, ORDER_FEATURES)
    done = prep.transform_data(model, rows, ORDER_FEATURES)
    return done.select("o_orderkey", (F.col("price") / 1000).alias("label"), "features")


def settled(df):
    """A one-row result as a table of its own."""
    return df.sparkSession.createDataFrame([tuple(df.first())], df.schema)


# ---- preparation ------------------------------------------------------------

@query("fit_preprocessor")
def fit_preprocessor(spark, d):
    from pyspark.ml.functions import vector_to_array
    return encoded(spark, d).select("doc_id", vector_to_array("features").alias("features"))


@query("feature_names")
def feature_names(spark, d):
    return prep.feature_names(encoded(spark, d))


@query("model_round_trip", f"WITH s AS ({SCORED}) SELECT id FROM s")
def model_round_trip(spark, d):
    """Store a fitted preprocessor, load it again, and keep the rows both encode alike: all of them."""
    rows = labelled_documents(spark, d)
    model = prep.fit_preprocessor(rows, NUMBERS + TEXTS)
    path = scratch_folder(spark, "preprocessor")
    tables.save_model(model, path)
    again = tables.load_model(path).transform(rows).select("doc_id", F.col("features").alias("again"))
    both = model.transform(rows).select("doc_id", "features").join(again, "doc_id")
    return both.where(F.col("features") == F.col("again")).select(F.col("doc_id").alias("id"))


# ---- linear models ----------------------------------------------------------

def _regression(fit):
    def run(spark, d):
        with reused(splits.train_test_split(encoded_orders(spark, d), ["o_orderkey"])) as parts:
            model = fit(splits.part_of(parts, "train"), "label")
            return settled(regression_metrics(linear.predict(model, splits.part_of(parts, "test")), "label", "prediction"))
    return run


for _name, _fit in (("fit_linear_regression", linear.linear_regression), ("fit_ridge", linear.ridge), ("fit_lasso", linear.lasso),
                    ("fit_elastic_net", linear.elastic_net)):
    query(_name)(_regression(_fit))


def _classification(fit):
    def run(spark, d):
        with reused(splits.stratified_split(encoded(spark, d), "label", ["doc_id"])) as parts:
            model = fit(splits.part_of(parts, "train"), "label")
            scores = linear.predict(model, splits.part_of(parts, "test"))
            return settled(classification_metrics(scores, "label", "prediction", "score"))
    return run


for _name, _fit in (("fit_logistic", linear.logistic), ("fit_ridge_logistic", linear.ridge_logistic), ("fit_decision_tree", trees.decision_tree),
                    ("fit_random_forest", trees.random_forest),
                    ("fit_gradient_boosting", lambda t, y: trees.gradient_boosting(t, y, trees=20))):
    query(_name)(_classification(_fit))


@query("predict_probability")
def predict_probability(spark, d):
    rows = encoded(spark, d)
    return linear.predict(linear.ridge_logistic(rows, "label"), rows).select("doc_id", "label", "score", "prediction")


@query("run_supervised")
def run_supervised(spark, d):
    rows = order_features(spark, d).withColumn("late", (F.col("o_orderstatus") == "F").cast("int"))
    return modelling.run_supervised(rows, ["o_orderkey"], ORDER_FEATURES, "price", "late")


# ---- trees ------------------------------------------------------------------

def boosted_rows(spark, d):
    return labelled_documents(spark, d).withColumn("english", (F.col("lang") == "en").cast("int"))


BOOST_FEATURES = [*NUMBERS, "english"]


def _boosted(fit):
    def run(spark, d):
        with reused(splits.stratified_split(boosted_rows(spark, d), "quality", ["doc_id"])) as parts:
            model = fit(splits.part_of(parts, "train"))
            scores = model.transform(splits.part_of(parts, "test"))
            return settled(classification_metrics(scores, "quality", "prediction", "score"))
    return run


query("fit_adaboost")(_boosted(lambda t: boosting.adaboost(t, "quality", BOOST_FEATURES)))
query("fit_newton_boost")(_boosted(lambda t: boosting.newton_boost(t, "quality", BOOST_FEATURES, ["doc_id"], trees=30)))
query("fit_newton_boost_leafwise")(_boosted(lambda t: boosting.newton_boost(
    t, "quality", BOOST_FEATURES, ["doc_id"], trees=12, growth="leaf", lam=0.0, min_weight=1e-3, min_rows=20, subsample=1.0)))


@query("feature_importance")
def feature_importance(spark, d):
    rows = encoded(spark, d)
    return rounded(trees.feature_importance(trees.random_forest(rows, "label"), rows, prep.slot_names(rows)))


@query("boosted_importance")
def boosted_importance(spark, d):
    rows = boosted_rows(spark, d)
    model = boosting.newton_boost(rows, "quality", BOOST_FEATURES, ["doc_id"], trees=10)
    return rounded(model.feature_importance(rows))


@query("run_trees")
def run_trees(spark, d):
    return modelling.run_trees(labelled_documents(spark, d), ["doc_id"], NUMBERS + TEXTS, "quality")[0]


# ---- validation and search --------------------------------------------------

FOREST = {"trees": [10, 50, 100], "depth": [3, 5, 10], "min_split": [2, 5]}
CHOICES = {"trees": list(range(10, 200, 10)), "depth": list(range(2, 20)), "min_split": list(range(2, 11)), "min_leaf": list(range(1, 6))}
POOL = {"trees": [20, 50, 80, 100, 150, 200], "depth": [3, 5, 8, 10, 12, 15], "min_split": [2, 4, 6, 8, 10]}


@query("holdout_validate")
def holdout_validate(spark, d):
    return search.holdout_validate(encoded(spark, d), ["doc_id"], "label")


@query("cross_validate")
def cross_validate(spark, d):
    return search.cross_validate(encoded(spark, d), ["doc_id"], "label")


@query("platt_calibrate")
def platt_calibrate(spark, d):
    return search.platt_calibrate(encoded(spark, d), ["doc_id"], "label")


@query("grid_search_cv")
def grid_search_cv(spark, d):
    return search.grid_search_cv(encoded(spark, d), ["doc_id"], "label", FOREST)


@query("refit_best", """WITH c AS (SELECT count(*) AS n FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
 SELECT 18 AS trials, TRUE AS size_fits, TRUE AS limits_hold, n AS "rows" FROM c""")
def refit_best(spark, d):
    """The best of the grid, fitted on all rows: as many trees as its trial says, none deeper, no smaller node split."""
    rows = encoded(spark, d)
    trials = search.grid_search_cv(rows, ["doc_id"], "label", FOREST)
    with reused(trials) as found:
        best = search.best_trial(found).first()
        model = search.refit_best(rows, found, "label", list(FOREST))
        n = found.count()
    fine = all(t.depth().max() <= best["depth"] and (t.rows[t.feature >= 0] >= best["min_split"]).all() for t in model.trees)
    return small_frame(spark, [(n, len(model.trees) == best["trees"], fine)], "trials int, size_fits boolean, limits_hold boolean").withColumn(
        "rows", F.lit(model.transform(rows).where(F.col("prediction").isin(0.0, 1.0)).count()).cast("long"))


@query("random_search_cv")
def random_search_cv(spark, d):
    return search.random_search_cv(encoded(spark, d), ["doc_id"], "label", CHOICES)


@query("bayesian_search_cv")
def bayesian_search_cv(spark, d):
    return search.bayesian_search_cv(encoded(spark, d), ["doc_id"], "label", POOL)


@query("run_validation")
def run_validation(spark, d):
    out = exploration.run_validation(encoded(spark, d), ["doc_id"], "label", "features", {"trees": [10], "depth": [3, 5]},
                                     {"trees": [10, 20], "depth": [3, 5]}, n_iter=2, k=3)
    return out["search_summary"]
