"""Golden rows, edge cases and schema operators."""

import pytest
from pyspark.sql import functions as F

from tabulith.operators import charts, cleaning, columns, features, metrics, prep, statistics
from tabulith.operators.windows import sample_n

ROWS = [
    ([6.02, 6.54, 6.52, 6.0, 6.47, 5.91, 6.49, 5.5], 6.29, 73.3, [1, 2, 2, 2, 0], [66.7, 2.2, 49.4, 47.8]),
    ([5.84, 5.12, 5.34, 5.18, 5.03, 4.93, 5.4, 5.13], 5.23, 54.5, [0, 1, 0, 1, 0], [48.2, 2.4, 26.7, 25.8]),
    ([4.91, 5.29, 5.49, 5.73, 5.33, 5.88, 5.82, 5.67], 5.52, 77.6, [1, 3, 1, 1, 0], [73.8, 2.8, 67.7, 41.5]),
]
WANT = [(6.18125, 0.3814797317, 6.602, 50.84, 37.48, 1.5), (5.24625, 0.2842502670, 5.296, 34.76, 25.08, 0.45),
        (5.515, 0.3268901082, 6.192, 62.2, 36.1, 1.5)]


def test_golden_scores(spark):
    names = [f"term{i}" for i in range(8)] + ["grade", "attendance", "a", "b", "c", "d", "e", "apt", "soft", "code", "mock"]
    flat = [(*t, g, p, *map(float, act), *tests) for t, g, p, act, tests in ROWS]
    df = spark.createDataFrame(flat, ", ".join(f"{n} double" for n in names))
    made = features.engineer_features(df, "term", "mean", "spread", weighted_scores={
        "academic": {"grade": 0.7, "attendance": 0.03}, "skill": {"apt": 0.4, "code": 0.4, "soft": 2.0},
        "interview": {"mock": 0.6, "soft": 4.0}, "experience": {"a": 0.3, "b": 0.3, "c": 0.15, "d": 0.15, "e": 0.1}})
    got = made.select("mean", "spread", "academic", "skill", "interview", "experience").collect()
    for row, want in zip(got, WANT):
        assert list(row) == pytest.approx(list(want), abs=1e-9)


def test_schema_operators(spark):
    df = spark.createDataFrame([(1, 2.0, "x", True)], "a int, b double, c string, d boolean")
    assert columns.numeric_columns(df) == ["a", "b"] and columns.categorical_columns(df) == ["c", "d"]
    assert columns.numeric_columns(df, ["b", "c"]) == ["b"]
    with pytest.raises(ValueError, match="missing columns: z"):
        columns.require_columns(df, ["a", "z"])
    diff = columns.feature_diff(df, df.withColumn("e", F.lit(1))).first()
    assert (diff["columns_before"], diff["columns_after"], diff["names"]) == (4, 5, ["e"])
    types = {r["dtype"]: r["columns"] for r in statistics.dtype_distribution(df).collect()}
    assert types == {"int": 1, "double": 1, "string": 1, "boolean": 1}


def test_empty_and_constant_inputs(spark):
    empty = spark.createDataFrame([], "id long, v double, t string, y int")
    assert cleaning.fill_numeric(empty, ["v"]).count() == 0
    assert statistics.describe(empty, ["v"]).first()["count"] == 0
    assert [r["count"] for r in charts.histogram(empty, "v", 5).collect()] == [0] * 5
    with pytest.raises(ValueError, match="no rows"):
        cleaning.clean_data(spark.createDataFrame([("maybe", 1.0)], "y string, v double"), "y")
    constant = spark.range(5).withColumn("v", F.lit(3.0))
    assert [r.v for r in prep.scale_columns(constant, ["v"]).collect()] == [0.0] * 5
    assert [r.s for r in features.add_minmax_score(constant, ["v"], "s").collect()] == [3.0] * 5
    assert sum(r["count"] for r in charts.histogram(constant, "v", 4).collect()) == 5


def test_one_class_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.3), (1, 0, 0.4)], "y int, p int, s double")
    row = metrics.classification_metrics(df, "y", "p", "s", single_class=1.0).first()
    assert row["roc_auc"] == 1.0 and row["recall"] == 0.5
    none = metrics.classification_metrics(df.withColumn("y", F.lit(0)).withColumn("p", F.lit(0)), "y", "p").first()
    assert none["precision"] == 0.0 and none["f1"] == 0.0
    clusters = df.withColumn("c", F.lit(0))
    assert metrics.cluster_metrics(clusters, ["s"], "c").first()["silhouette"] == 0.0
    assert metrics.silhouette(clusters, ["s"], "c", mode="squared").first()[0] == 0.0


def test_target_texts_and_numbers(spark):
    df = spark.createDataFrame([(" PLACED ", 1), ("not_placed", 2), ("1", 3), ("7.5", 4), (None, 5)], "y string, id int")
    assert sorted((r.id, r.y) for r in cleaning.clean_binary_target(df, "y").collect()) == [(1, 1.0), (2, 0.0), (3, 1.0), (4, 7.5)]
    two = spark.createDataFrame([(2.0,), (9.0,), (2.0,)], "y double")
    assert sorted(r.y for r in cleaning.recode_two_values(two, "y").collect()) == [0.0, 0.0, 1.0]
    three = spark.createDataFrame([(2.0,), (9.0,), (4.0,)], "y double")
    assert sorted(r.y for r in cleaning.recode_two_values(three, "y").collect()) == [2.0, 4.0, 9.0]


def test_unseen_levels_encode_as_zeros(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0), ("b", None)], "t string, v double")
    model = prep.fit_preprocessor(train, ["v", "t"])
    encoded = prep.transform_data(model, spark.createDataFrame([("zzz", 2.0), ("b", 2.0)], "t string, v double"), ["v", "t"])
    assert [list(r["features"].toArray()) for r in encoded.collect()] == [[0.0, 0.0, 0.0], [0.0, 0.0, 1.0]]
    assert prep.slot_names(encoded) == ["v", "t_a", "t_b"]


def test_sample_is_whole_when_small(spark):
    assert sample_n(spark.range(3), 10, ["id"]).count() == 3
