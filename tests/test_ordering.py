"""Bucketed orders, ranks and quantiles against plain numpy, with hot values, gaps and infinities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulith.operators import ordering, splits


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    values = [None if i % 17 == 0 else 5.0 if i % 3 == 0 else float("inf") if i % 29 == 0 else float(round(rng.normal() * 10, 2))
              for i in range(3000)]
    return spark.createDataFrame([(i, v, "a" if i % 3 else "b") for i, v in enumerate(values)], "id long, v double, g string").cache()


@pytest.mark.parametrize("buckets", [8, 1024])
def test_quantiles_are_exact(rows, buckets):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = ordering.quantiles(rows.where(F.col("v") < 1e300), ["v"], probs, buckets=buckets).first()["q"]
    values = [r.v for r in rows.collect() if r.v is not None and r.v < 1e300]
    assert np.allclose(got, np.quantile(values, probs))


def test_bucketed_quantiles_with_an_empty_and_a_constant_column(rows):
    df = rows.select("v", F.lit(None).cast("double").alias("none"), F.lit(7.0).alias("same"))
    got = {r.column: r.q for r in ordering.quantiles(df, ["v", "none", "same"], [0.5], buckets=8).collect()}
    values = [r.v for r in rows.collect() if r.v is not None]
    assert got == {"v": [np.quantile(values, 0.5)], "none": None, "same": [7.0]}


def test_quantiles_keep_infinity_and_groups(rows):
    got = {r.g: r.q for r in ordering.quantiles(rows, ["v"], [0.5, 1.0], ["g"], buckets=16).collect()}
    for g in "ab":
        values = [r.v for r in rows.collect() if r.g == g and r.v is not None]
        assert got[g] == [np.quantile(values, 0.5), max(values)]
    assert got["a"][1] == float("inf")


@pytest.mark.parametrize("descending", [False, True])
def test_row_ranks_with_a_hot_value(rows, descending):
    known = rows.where(F.col("v").isNotNull())
    got = {r.id: r["rank"] for r in ordering.row_ranks(known, "v", "id", descending=descending, buckets=8).collect()}
    order = sorted(known.collect(), key=lambda r: (-r.v if descending else r.v, r.id))
    assert got == {r.id: i + 1 for i, r in enumerate(order)}


def test_running_totals_bucketed(spark):
    df = spark.range(2000).select((F.col("id") * 7 % 2000).alias("k"), (F.col("id") % 5).alias("w"))
    for descending in (False, True):
        got = {r.k: r.s for r in ordering.running_totals(df, "k", {"s": F.col("w")}, descending=descending, buckets=32).collect()}
        total, want = 0, {}
        for r in sorted(df.collect(), key=lambda r: -r.k if descending else r.k):
            total += r.w
            want[r.k] = total
        assert got == want


def test_ranks_do_not_depend_on_row_order(rows):
    a = ordering.hash_rank(rows, ["id"], by=["g"])
    b = ordering.hash_rank(rows.orderBy(F.desc("id")).repartition(7), ["id"], by=["g"])
    assert sorted(map(tuple, a.select("id", "rank").collect())) == sorted(map(tuple, b.select("id", "rank").collect()))


def test_split_sizes(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    parts = {r.part: r["count"] for r in splits.train_test_split(df, ["id"]).groupBy("part").count().collect()}
    assert parts == {"test": 201, "train": 802}
    by_class = {(r.y, r.part): r["count"] for r in splits.stratified_split(df, "y", ["id"]).groupBy("y", "part").count().collect()}
    assert by_class[0, "test"] + by_class[1, "test"] == 201 and by_class[1, "test"] == 20
    folds = [r["count"] for r in splits.kfold(df, ["id"], 5).groupBy("fold").count().collect()]
    assert sorted(folds) == [200, 200, 201, 201, 201]
