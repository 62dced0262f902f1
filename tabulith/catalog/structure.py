"""Clusters, components, neighbour graphs, report tables and stored results."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..operators import charts, clustering, manifold, prep, reduction
from ..plans import examples, exploration, preparation
from ..runtime import scratch_folder
from ..sources import tables
from . import query, table
from .selection import md5
from .shared import ITEMS, cte, items, rounded

XY = ["p_size", "p_retailprice"]
RATES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def scaled_items(spark, d):
    rows = table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), *RATES)
    return prep.scale_columns(rows, RATES)


# ---- clustering -------------------------------------------------------------

@query("fit_kmeans")
def fit_kmeans(spark, d):
    labels, _, inertia = clustering.kmeans(scaled_items(spark, d), RATES)
    return clustering.cluster_distribution(labels, "cluster").withColumn("inertia", F.lit(inertia))


@query("fit_kmeans_pp")
def fit_kmeans_pp(spark, d):
    labels, _, inertia = clustering.kmeans_pp(scaled_items(spark, d), RATES)
    return clustering.cluster_distribution(labels, "cluster").withColumn("inertia", F.lit(inertia))


NEAR = "sqrt((a.p_size - b.p_size) ** 2 + (a.p_retailprice - b.p_retailprice) ** 2) <= 1.2"


@query("core_points", f"""SELECT a.p_partkey, count(*) AS neighbors, count(*) >= 4 AS core FROM part a JOIN part b ON {NEAR} GROUP BY 1""")
def core_points(spark, d):
    return clustering.core_points(table(spark, d, "part"), "p_partkey", XY, 1.2, 4)


@query("dbscan_2d", f"""WITH RECURSIVE e AS (SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON {NEAR}),
 c AS (SELECT a AS id FROM e GROUP BY 1 HAVING count(*) >= 4),
 ce AS (SELECT a, b FROM e WHERE a IN (SELECT id FROM c) AND b IN (SELECT id FROM c)),
 r(id, root) AS (SELECT id, id FROM c UNION SELECT ce.b, r.root FROM r JOIN ce ON ce.a = r.id WHERE r.root < ce.b),
 comp AS (SELECT id, min(root) AS root FROM r GROUP BY 1),
 num AS (SELECT root, cast(row_number() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT root FROM comp)),
 l AS (SELECT id, cluster, 'core' AS kind FROM comp JOIN num USING (root)
  UNION ALL SELECT e.a, min(cluster), 'border' FROM e JOIN comp ON comp.id = e.b JOIN num USING (root) WHERE e.a NOT IN (SELECT id FROM c) GROUP BY 1)
 SELECT p_partkey, coalesce(cluster, -1) AS cluster, coalesce(kind, 'noise') AS kind FROM part LEFT JOIN l ON id = p_partkey""")
def dbscan_2d(spark, d):
    return clustering.dbscan(table(spark, d, "part").select("p_partkey", *XY), "p_partkey", XY, 1.2, 4).select("p_partkey", "cluster", "kind")


@query("fit_dbscan")
def fit_dbscan(spark, d):
    labels = clustering.dbscan(scaled_items(spark, d).select("id", "l_quantity", "l_extendedprice"), "id", ["l_quantity", "l_extendedprice"], 0.05, 10)
    return labels.groupBy("cluster", "kind").agg(F.count("*").alias("rows"))


@query("fit_hierarchical")
def fit_hierarchical(spark, d):
    labels, _ = clustering.hierarchical(scaled_items(spark, d), RATES)
    return clustering.cluster_distribution(labels, "cluster")


@query("dendrogram")
def dendrogram(spark, d):
    return clustering.dendrogram_table(scaled_items(spark, d), RATES, 120)


@query("run_unsupervised")
def run_unsupervised(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return exploration.run_unsupervised(rows, "c_custkey", eps=0.3, n_init=2)["results"]


# ---- components -------------------------------------------------------------

@query("pca_variance")
def pca_variance(spark, d):
    rows = scaled_items(spark, d)
    return rounded(reduction.pca(rows, RATES, scaled=True).variance_table(rows))


@query("pca_loadings")
def pca_loadings(spark, d):
    rows = scaled_items(spark, d)
    return rounded(reduction.pca(rows, RATES, scaled=True).loadings_table(rows), 4)


def wide_vectors(spark, d):
    rows = table(spark, d, "embeddings")
    names = [f"e{i}" for i in range(64)]
    return rows.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), names


@query("pca_reduce")
def pca_reduce(spark, d):
    rows, names = wide_vectors(spark, d)
    scaled = prep.scale_columns(rows, names)
    reduced, columns = reduction.pca_reduce(scaled, names)
    return rounded(reduced.select("vec_id", *columns), 4)


@query("projection_data")
def projection_data(spark, d):
    rows, names = wide_vectors(spark, d)
    found = reduction.pca(rows, names, variance=None, k=2)
    return rounded(charts.projection_data(found.transform(rows), rows, "vec_id", ["PC1", "PC2"], "label"), 4)


@query("pca_2col_customers", """WITH t AS (SELECT c_custkey, c_acctbal / 1000 AS x, cast(c_nationkey AS DOUBLE) AS y FROM customer),
 s AS (SELECT avg(x) AS ma, avg(y) AS mb, var_samp(x) AS va, var_samp(y) AS vb, covar_samp(x, y) AS c FROM t),
 e AS (SELECT *, (va + vb) / 2 + sqrt((va - vb) ** 2 / 4 + c * c) AS l1, (va + vb) / 2 - sqrt((va - vb) ** 2 / 4 + c * c) AS l2 FROM s)
 SELECT 1 AS component, round(l1 / (l1 + l2), 4) AS explained_variance FROM e UNION ALL SELECT 2, round(l2 / (l1 + l2), 4) FROM e""")
def pca_2col_customers(spark, d):
    rows = table(spark, d, "customer").select((F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    components = reduction.pca(rows, ["x", "y"], variance=None, k=2, scaled=True)
    return rounded(components.variance_table(rows).select("component", "explained_variance"), 4)


# ---- neighbour graphs and layouts -------------------------------------------

@query("fuzzy_graph")
def fuzzy_graph(spark, d):
    return rounded(manifold.fuzzy_graph(table(spark, d, "embeddings"), "vec_id", "embedding"), 5)


@query("strong_edges")
def strong_edges(spark, d):
    return rounded(manifold.strong_edges(manifold.fuzzy_graph(table(spark, d, "embeddings"), "vec_id", "embedding")), 5)


DIST = "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query("fuzzy_rho", f"""SELECT a.vec_id AS src, round(min({DIST}), 6) AS rho FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND {DIST} > 0 GROUP BY 1""")
def fuzzy_rho(spark, d):
    """Distance at which each row's kernel starts: its nearest neighbour that is not a copy."""
    graph = manifold.knn_graph(table(spark, d, "embeddings"), "vec_id", "embedding", 14)
    return rounded(graph.where(F.col("distance") > 0).groupBy("src").agg(F.min("distance").alias("rho")))


@query("tsne_affinities")
def tsne_affinities(spark, d):
    return rounded(manifold.tsne_affinities(table(spark, d, "embeddings"), "vec_id", "embedding"), 8)


@query("umap_layout")
def umap_layout(spark, d):
    return rounded(manifold.umap_layout(table(spark, d, "embeddings"), "vec_id", "embedding"), 4)


@query("tsne_layout")
def tsne_layout(spark, d):
    return rounded(manifold.tsne_layout(table(spark, d, "embeddings"), "vec_id", "embedding"), 4)


# ---- stored results ---------------------------------------------------------

@query("csv_round_trip", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, d):
    path = scratch_folder(spark, "customer-csv")
    tables.write_csv(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"), path)
    return tables.read_table(spark, path, "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string", ["c_acctbal"])


@query("csv_inferred", "SELECT cast(c_custkey AS INTEGER) AS c_custkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark, d):
    """Read without a schema, from the file found in the folder."""
    folder = scratch_folder(spark, "customer-inferred")
    tables.write_csv(table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), folder, single_file=True)
    return tables.read_table(spark, tables.resolve_source(spark, folder, ["absent.csv"]))


@query("json_round_trip", "SELECT o_orderstatus AS status, count(*) AS orders, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1")
def json_round_trip(spark, d):
    summary = rounded(table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("orders"), F.avg("o_totalprice").alias("mean_price")), 4)
    path = scratch_folder(spark, "summary-json")
    tables.write_json(summary, path)
    return spark.read.schema("status string, orders bigint, mean_price double").json(path)


@query("json_documents", """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","customers":' || count(c_custkey) || '}' AS "json"
 FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name""")
def json_documents(spark, d):
    counts = table(spark, d, "nation").join(table(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return tables.as_json(counts.groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("customers")))


@query("report_values", """WITH m AS (SELECT l_returnflag AS model, round(avg(l_extendedprice), 2) AS mae, count(*) AS "rows" FROM lineitem GROUP BY 1)
 SELECT 'mae' AS metric, printf('%.2f', mae) AS "value" FROM m WHERE model = 'R' UNION ALL SELECT 'rows', cast("rows" AS VARCHAR) FROM m WHERE model = 'R'""")
def report_values(spark, d):
    results = table(spark, d, "lineitem").groupBy(F.concat(F.lit(" "), "l_returnflag", F.lit(" ")).alias("model")).agg(
        F.format_string("%.2f", F.avg("l_extendedprice")).alias("mae"), F.lit(None).cast("double").alias("r2"), F.count("*").alias("rows"))
    path = scratch_folder(spark, "results-csv")
    tables.write_csv(results, path, single_file=True)
    schema = "model string, mae string, r2 double, rows bigint"
    stored = tables.read_table(spark, path, schema)
    return tables.report_values(stored, "model", "R", ["mae", "r2", "rows", "absent"])


@query("report_tables", 'SELECT c_mktsegment, count(*) AS "count" FROM customer GROUP BY 1')
def report_tables(spark, d):
    folder = scratch_folder(spark, "reports")
    tables.write_csv(table(spark, d, "customer").groupBy("c_mktsegment").count(), folder, single_file=True)
    stored = tables.report_tables(spark, folder)
    return next(iter(stored.values())).select("c_mktsegment", F.col("count").cast("bigint").alias("count"))


@query("matrix_round_trip", "SELECT p_partkey, [cast(p_size AS DOUBLE), p_retailprice] AS \"values\" FROM part")
def matrix_round_trip(spark, d):
    rows = VectorAssembler(inputCols=XY, outputCol="features").transform(table(spark, d, "part"))
    path = scratch_folder(spark, "matrix")
    tables.write_matrix(rows, "p_partkey", "features", path)
    return spark.read.parquet(path)


@query("embedding_round_trip", """SELECT vec_id, round(cast(embedding[1] AS DOUBLE), 6) AS dim1, round(cast(embedding[2] AS DOUBLE), 6) AS dim2, label FROM embeddings""")
def embedding_round_trip(spark, d):
    rows = table(spark, d, "embeddings")
    points = rows.select("vec_id", F.col("embedding")[0].cast("double").alias("dim1"), F.col("embedding")[1].cast("double").alias("dim2"))
    path = scratch_folder(spark, "embedding")
    tables.write_embedding(points, rows, "vec_id", "label", path)
    return rounded(tables.read_table(spark, path, "vec_id bigint, dim1 double, dim2 double, label int"))


@query("run_prepare")
def run_prepare(spark, d):
    folder = scratch_folder(spark, "prepared")
    raw = table(spark, d, "orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                               "CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS finished")
    raw.write.parquet(f"{folder}/raw.parquet")
    return preparation.run_prepare(spark, f"{folder}/raw.parquet", folder, ["o_orderkey"], ["o_totalprice", "o_orderpriority"], "finished")


# ---- report content ---------------------------------------------------------

@query("preview", f"SELECT c_custkey, c_acctbal FROM customer ORDER BY {md5('c_custkey', 7)} LIMIT 200")
def preview(spark, d):
    return examples.preview(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_custkey"])


@query("feature_sample", "SELECT cast(p_partkey AS VARCHAR) AS p_partkey, cast(p_size AS VARCHAR) AS p_size, '-' AS weight FROM part ORDER BY part.p_partkey LIMIT 10")
def feature_sample(spark, d):
    rows = table(spark, d, "part").withColumn("weight", F.lit(None).cast("double"))
    return examples.feature_sample(rows, ["p_partkey"], ["p_partkey", "p_size", "weight"])


@query("worked_examples", f"""WITH s AS (SELECT * FROM customer ORDER BY {md5('c_custkey', 7)} LIMIT 200),
 r AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS i FROM s)
 SELECT round((a.c_acctbal + a.c_nationkey) / 2, 2) AS row_mean,
  round(sqrt((a.c_acctbal - b.c_acctbal) ** 2 + (a.c_nationkey - b.c_nationkey) ** 2), 4) AS distance,
  round((SELECT 1 - sum(n * n) / (sum(n) * sum(n)) FROM (SELECT cast(count(*) AS DOUBLE) AS n FROM s GROUP BY c_mktsegment)), 4) AS gini
 FROM r a, r b WHERE a.i = 1 AND b.i = 2""")
def worked_examples(spark, d):
    pair = ["c_acctbal", "c_nationkey"]
    return examples.worked_examples(table(spark, d, "customer"), ["c_custkey"], pair, pair, "c_mktsegment")


PAIR = """SELECT round(sqrt((a.p_size - b.p_size) ** 2 + (a.p_retailprice - b.p_retailprice) ** 2), 6) AS distance FROM {t} a, {t} b,
 (SELECT min(p_partkey) AS lo, max(p_partkey) AS hi FROM part) WHERE a.p_partkey = lo AND b.p_partkey = hi"""


def _ends(spark, d):
    row = table(spark, d, "part").agg(F.min("p_partkey").alias("lo"), F.max("p_partkey").alias("hi")).first()
    return row["lo"], row["hi"]


@query("pair_distance", PAIR.format(t="part"))
def pair_distance(spark, d):
    return rounded(examples.pair_distance(table(spark, d, "part"), "p_partkey", XY, *_ends(spark, d)))


@query("standardised_pair_distance", f"""WITH z AS (SELECT p_partkey, (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS p_size,
 (p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER () AS p_retailprice FROM part) {PAIR.format(t="z")}""")
def standardised_pair_distance(spark, d):
    return rounded(examples.standardised_pair_distance(table(spark, d, "part"), "p_partkey", XY, *_ends(spark, d)))


@query("formatted_sample", f"""SELECT cast(c_custkey AS VARCHAR) AS c_custkey, printf('%.4f', c_acctbal) AS c_acctbal, c_mktsegment FROM
 (SELECT * FROM customer ORDER BY {md5('c_custkey')} LIMIT 20)""")
def formatted_sample(spark, d):
    return examples.formatted_sample(table(spark, d, "customer"), ["c_custkey"], ["c_custkey", "c_acctbal", "c_mktsegment"])


@query("scaling_card", " UNION ALL ".join(f"""SELECT '{c}' AS feature, round(avg({c}), 4) AS raw_mean, round(stddev_samp({c}), 4) AS raw_std,
 cast(0 AS DOUBLE) AS scaled_mean, cast(1 AS DOUBLE) AS scaled_std FROM part""" for c in XY))
def scaling_card(spark, d):
    return rounded(examples.scaling_card(table(spark, d, "part"), XY), 4)


@query("split_card", """WITH n AS (SELECT count(*) AS n, cast(round(count(*) * 0.8) AS BIGINT) AS k FROM orders)
 SELECT 'Training' AS part, format('{:,}', k) AS "rows" FROM n UNION ALL SELECT 'Testing', format('{:,}', n - k) FROM n UNION ALL SELECT 'Total', format('{:,}', n) FROM n""")
def split_card(spark, d):
    return examples.split_card(table(spark, d, "orders"))


@query("algorithm_cards", "WITH " + cte("t", ITEMS, "lineitem") + """, m AS (SELECT median(quantity) AS q FROM t)
 SELECT 'exploration' AS card, 'quantity' AS name, round(q, 4) AS "value" FROM m
 UNION ALL SELECT 'gini', 'status', round(1 - sum(n * n) / (sum(n) * sum(n)), 4) FROM (SELECT cast(count(*) AS DOUBLE) AS n FROM t GROUP BY status)
 UNION ALL SELECT 'missing_values', 'flag', cast(count(*) - count(flag) AS DOUBLE) FROM t
 UNION ALL SELECT 'duplicates', 'rows', cast(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS DOUBLE) FROM t""")
def algorithm_cards(spark, d):
    cards = examples.algorithm_cards(items(spark, d).drop("nothing").withColumn("nothing", F.lit(None).cast("string")), ["quantity"],
                                     ["quantity", "discount"], "status")

    def line(card, name, frame, value):
        return frame.select(F.lit(card).alias("card"), F.lit(name).alias("name"), F.round(F.col(value).cast("double"), 4).alias("value"))

    return (line("exploration", "quantity", cards["exploration"].where(F.col("column") == "quantity"), "median")
            .unionByName(line("gini", "status", cards["gini"], "gini"))
            .unionByName(line("missing_values", "flag", cards["missing_values"].where(F.col("column") == "flag"), "missing_count"))
            .unionByName(line("duplicates", "rows", cards["duplicates"], "duplicate_rows")))
