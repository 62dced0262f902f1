"""Approximate nearest neighbours: trees of random projections held as tables, joined to neighbours of neighbours.

A tree cuts every node above ``leaf_rows`` vectors at the medians of three random projections at once, so a level is
one aggregate and one join and the depth is a third of a binary tree's. Vectors of one leaf are compared with each
other. After every round of trees the neighbours' neighbours are compared too, and the recall is measured: the true
neighbours of a fixed number of vectors are found in one pass over all. Rounds go on until the recall asked for
is reached; if it never is, the exact join answers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .joins import collapsed, expanded, knn_join
from .ordering import hash_key

CUTS = 3  # projections, and so bits of a path, per level
LEVELS = 20
SALTS = 32  # parts of a node's rows in the join with the table of cuts, so that the root is not one key


def _nearest(a: np.ndarray, b: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and exact distances of at least the ``take`` nearest rows of b (in given order on ties) per row of a."""
    take = min(take, len(b))
    rough = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2.0 * a @ b.T
    slack = 1e-9 * (1.0 + np.abs(rough).max())
    limit = np.partition(rough, take - 1, axis=1)[:, take - 1] + slack
    out, far = np.zeros((len(a), take), int), np.zeros((len(a), take))
    for i, row in enumerate(rough):
        j = np.nonzero(row <= limit[i])[0]
        exact = np.sqrt(((a[i] - b[j]) ** 2).sum(1))
        best = np.argsort(exact, kind="stable")[:take]
        out[i], far[i] = j[best], exact[best]
    return out, far


def _leaves(members: DataFrame, trees: range, leaf_rows: int, seed: int) -> DataFrame:
    """Every vector once per tree, with the path of its leaf."""
    id_type = members.schema["low"].dataType.simpleString()
    schema = f"g string, low {id_type}, v array<double>, tree int, path long, closed boolean"
    frame = members.select("g", "low", "v", F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"),
                           F.lit(0).cast("long").alias("path"), F.lit(False).alias("closed"))
    for level in range(LEVELS):
        def projected(batches, level=level):
            for pdf in batches:
                if pdf.empty:
                    continue
                x, cut = np.array(pdf["v"].tolist()), np.zeros((len(pdf), CUTS))
                for tree in pdf["tree"].unique():
                    here = (pdf["tree"] == tree).to_numpy()
                    cut[here] = x[here] @ np.random.default_rng((seed, int(tree), level)).normal(size=(x.shape[1], CUTS))
                yield pdf.assign(**{f"p{i}": cut[:, i] for i in range(CUTS)})

        moving = frame.where(~F.col("closed")).mapInPandas(projected, schema + "".join(f", p{i} double" for i in range(CUTS)))
        nodes = moving.groupBy("tree", "path").agg(F.count("*").alias("n"), *[
            F.percentile_approx(f"p{i}", 0.5, 200).alias(f"m{i}") for i in range(CUTS)])
        nodes = nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        side = sum(((F.col(f"p{i}") > F.col(f"m{i}")).cast("long") * 2**i for i in range(CUTS)), F.lit(0).cast("long"))
        small = F.col("n") <= leaf_rows
        moved = (moving.withColumn("salt", F.pmod(F.xxhash64("g"), F.lit(SALTS)).cast("int")).join(nodes, ["tree", "path", "salt"])
                 .select("g", "low", "v", "tree", F.when(small, F.col("path")).otherwise(F.col("path") * 2**CUTS + side + 1).alias("path"),
                         small.alias("closed")))
        frame = cut_lineage(frame.where("closed").unionByName(moved))
        if frame.where(~F.col("closed")).isEmpty():
            break
    # vectors that no projection parts are compared in blocks, by code
    sizes = frame.where(~F.col("closed")).groupBy("tree", "path").agg(F.count("*").alias("n"))
    return frame.join(sizes, ["tree", "path"], "left").withColumn(
        "block", F.pmod(F.xxhash64("g"), F.ceil(F.coalesce("n", F.lit(1)) / leaf_rows)).cast("int")).drop("n")


def _best(found: DataFrame, take: int) -> DataFrame:
    """The nearest ``take`` vectors of every vector, each once."""
    once = found.groupBy("g", "h").agg(F.min("low").alias("low"), F.min("distance").alias("distance"))
    order = Window.partitionBy("g").orderBy("distance", "low")
    return cut_lineage(once.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= take).drop("_r"))


def _within(leaves: DataFrame, take: int, id_type: str) -> DataFrame:
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("low", kind="stable")
        x, g, low = np.array(pdf["v"].tolist()), pdf["g"].to_numpy(), pdf["low"].to_numpy()
        j, far = _nearest(x, x, take)
        return pd.DataFrame({"g": np.repeat(g, j.shape[1]), "h": g[j.ravel()], "low": low[j.ravel()], "distance": far.ravel()})
    return leaves.groupBy("tree", "path", "block").applyInPandas(compare, f"g string, h string, low {id_type}, distance double")


def _beyond(best: DataFrame, members: DataFrame) -> DataFrame:
    """Distances to the neighbours of each vector's neighbours: at most (k + 1) squared per vector."""
    hop = best.select(F.col("g").alias("h"), F.col("h").alias("far"))
    pairs = best.select("g", "h").join(hop, "h").select("g", F.col("far").alias("h")).distinct().join(best.select("g", "h"), ["g", "h"], "left_anti")
    a, b = members.select("g", F.col("v").alias("a")), members.select(F.col("g").alias("h"), "low", F.col("v").alias("b"))
    gap = F.sqrt(F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return pairs.join(a, "g").join(b, "h").select("g", "h", "low", gap.alias("distance"))


def measured_recall(members: DataFrame, best: DataFrame, k: int, audit: int, seed: int) -> float:
    """Share of the ``audit`` vectors' true k nearest other vectors that are as near in ``best``; one pass over all vectors."""
    asked = members.orderBy(hash_key(["g"], seed)).limit(audit).select("g", "v").collect()  # a fixed number of vectors
    names, points = np.array([r["g"] for r in asked]), np.array([r["v"] for r in asked])

    def nearest(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            j, far = _nearest(points, np.array(pdf["v"].tolist()), k + 1)
            g = np.repeat(names, j.shape[1])
            other = g != pdf["g"].to_numpy()[j.ravel()]
            yield pd.DataFrame({"g": g[other], "distance": far.ravel()[other]})

    order = Window.partitionBy("g").orderBy("distance")
    true = (members.select("g", "v").mapInPandas(nearest, "g string, distance double")
            .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
            .groupBy("g").agg(F.max("distance").alias("reach"), F.count("*").alias("n")))
    near = best.where(F.col("g") != F.col("h")).join(F.broadcast(true), "g")  # at most `audit` rows
    hits = near.where(F.col("distance") <= F.col("reach") * (1 + 1e-9)).groupBy("g").agg(F.count("*").alias("hits"))
    row = true.join(hits, "g", "left").agg(F.sum("n").alias("n"), F.sum(F.least("n", F.coalesce("hits", F.lit(0)))).alias("hits")).first()
    return float(row["hits"] / row["n"]) if row["n"] else 1.0


def approximate_knn(points: DataFrame, key: str, vector: str, k: int, recall: float = 0.95, trees: int = 4, leaf_rows: int = 256,
                    audit: int = 200, rounds: int = 5, seed: int = 42) -> tuple[DataFrame, float]:
    """(k nearest other rows found, as ``knn_join`` gives them; measured recall over distinct vectors).

    Grows ``trees`` trees a round until ``audit`` vectors, drawn by hash, show the ``recall`` asked for; after ``rounds`` without it
    the exact join is returned, with recall 1. Rows with equal vectors are one vector, so copies are never missed.
    """
    rows, members = collapsed(points, key, vector, k)
    id_type = members.schema["low"].dataType.simpleString()
    take, best = k + 1, None
    for turn in range(rounds):
        found = _within(_leaves(members, range(turn * trees, (turn + 1) * trees), leaf_rows, seed), take, id_type)
        best = _best(found if best is None else found.unionByName(best), take)
        best = _best(best.unionByName(_beyond(best, members)), take)
        seen = measured_recall(members, best, k, audit, seed)
        if seen >= recall:
            return expanded(rows, members, best, k), seen
    return knn_join(points, key, vector, k), 1.0
