"""Metrics of given predictions, single model steps with a closed form, and chart tables."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..operators import charts, clustering, linear, metrics, splits, statistics, trees
from ..operators.joins import distance_join
from ..runtime import one_row
from . import query, table
from .selection import CENTERS, NEAREST, md5
from .shared import ITEMS, SCORED, cte, items, rounded, scored

T_SCORED = f"WITH s AS ({SCORED})"
GUESSED = "1500.0 * l_quantity"


def predicted(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("y"),
                                              (F.lit(1500.0) * F.col("l_quantity")).alias("p"))


@query("regression_metrics", f"""WITH t AS (SELECT l_extendedprice AS y, {GUESSED} AS p FROM lineitem)
 SELECT round(avg(abs(y - p)), 4) AS mae, round(avg((y - p) ** 2), 2) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse,
 round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2 FROM t""")
def regression_metrics(spark, d):
    m = metrics.regression_metrics(predicted(spark, d), "y", "p")
    return m.select(F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


CELLS = """count(*) FILTER (WHERE y <> 1 AND guess <> 1) AS tn, count(*) FILTER (WHERE y <> 1 AND guess = 1) AS fp,
 count(*) FILTER (WHERE y = 1 AND guess <> 1) AS fn, count(*) FILTER (WHERE y = 1 AND guess = 1) AS tp"""


@query("confusion", f"{T_SCORED} SELECT {CELLS} FROM s")
def confusion(spark, d):
    return metrics.confusion_matrix(scored(spark, d), "y", "guess")


AUC = """(SELECT (sum(r) - p * (p + 1) / 2.0) / (p * n) FROM (SELECT y, avg(i) OVER (PARTITION BY score) AS r FROM
  (SELECT y, score, row_number() OVER (ORDER BY score) AS i FROM s)), (SELECT count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y <> 1) AS n FROM s)
  WHERE y = 1 GROUP BY p, n)"""


@query("classification_metrics", f"""{T_SCORED}, c AS (SELECT {CELLS} FROM s) SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
 round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round({AUC}, 6) AS roc_auc FROM c""")
def classification_metrics(spark, d):
    return rounded(metrics.classification_metrics(scored(spark, d), "y", "guess", "score"))


@query("roc_auc", f"{T_SCORED} SELECT round({AUC}, 6) AS roc_auc")
def roc_auc(spark, d):
    """The bucketed path, forced."""
    return rounded(metrics.roc_auc(scored(spark, d), "y", "score", buckets=16))


POINTS = """, g AS (SELECT score AS threshold, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM s GROUP BY 1),
 c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n, row_number() OVER w AS r,
  lead(pos) OVER w AS np, lead(neg) OVER w AS nn FROM g WINDOW w AS (ORDER BY threshold DESC))"""


@query("roc_curve", f"""{T_SCORED}{POINTS} SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c
 WHERE r = 1 OR np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0""")
def roc_curve(spark, d):
    return rounded(metrics.roc_curve(scored(spark, d), "y", "score"))


@query("youden", f"""{T_SCORED}{POINTS} SELECT threshold, round(tp / p - fp / n, 6) AS youden_j FROM c ORDER BY round(tp / p - fp / n, 12) DESC, threshold DESC LIMIT 1""")
def youden(spark, d):
    return rounded(metrics.youden_threshold(scored(spark, d), "y", "score"))


@query("brier", f"""{T_SCORED} SELECT round(avg((score - y) ** 2), 6) AS brier_before, round(avg((0.5 + score / 2 - y) ** 2), 6) AS brier_after,
 round(avg((score - y) ** 2) - avg((0.5 + score / 2 - y) ** 2), 6) AS improvement FROM s""")
def brier(spark, d):
    rows = scored(spark, d).withColumn("calibrated", 0.5 + F.col("score") / 2)
    return rounded(metrics.brier_score(rows, "y", "score", "calibrated"))


@query("calibration_table", f"""{T_SCORED} SELECT id, y AS actual, round(score * 0.9871, 4) AS raw, round(0.4 + score / 2.0173, 4) AS calibrated,
 round(0.4 + score / 2.0173 - score * 0.9871, 4) AS diff FROM s ORDER BY id LIMIT 10""")
def calibration_table(spark, d):
    rows = scored(spark, d).withColumn("calibrated", 0.4 + F.col("score") / 2.0173).withColumn("raw_score", F.col("score") * 0.9871)
    return metrics.calibration_table(rows, ["id"], "y", "raw_score", "calibrated")


@query("model_comparison", """WITH m AS (SELECT l_returnflag AS model, sqrt(avg((l_extendedprice - 1500.0 * l_quantity) ** 2)) AS rmse FROM lineitem GROUP BY 1)
 SELECT model, round(rmse, 4) AS rmse, round(rmse / max(rmse) OVER (), 6) AS normalized_rmse FROM m""")
def model_comparison(spark, d):
    e = F.col("l_extendedprice") - F.lit(1500.0) * F.col("l_quantity")
    results = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(F.sqrt(F.avg(e * e)).alias("rmse"))
    compared = metrics.model_comparison(results)
    return compared.select("model", F.round("rmse", 4).alias("rmse"), F.round("normalized_rmse", 6).alias("normalized_rmse"))


# ---- cluster measures -------------------------------------------------------

def assigned(spark, d):
    return distance_join(table(spark, d, "part"), ["p_size", "p_retailprice"], CENTERS)


XY = ["p_size", "p_retailprice"]


@query("lloyd_step", f"""{NEAREST} SELECT cluster, count(*) AS size, round(avg(p_size), 4) AS mean_p_size,
 round(avg(p_retailprice), 4) AS mean_p_retailprice, round(sum(distance * distance), 2) AS inertia FROM a GROUP BY 1""")
def lloyd_step(spark, d):
    s = clustering.lloyd_step(table(spark, d, "part"), XY, CENTERS)
    return rounded(s, 4).withColumn("inertia", F.round("inertia", 2))


@query("seed_weights", f"{NEAREST} SELECT p_partkey, round(distance, 6) AS distance, round(distance * distance / sum(distance * distance) OVER (), 9) AS weight FROM a")
def seed_weights(spark, d):
    w = clustering.seed_weights(table(spark, d, "part"), "p_partkey", XY, CENTERS)
    return w.select("p_partkey", F.round("distance", 6).alias("distance"), F.round("weight", 9).alias("weight"))


@query("cluster_sizes", f"{NEAREST} SELECT cluster, count(*) AS \"count\" FROM a GROUP BY 1")
def cluster_sizes(spark, d):
    return clustering.cluster_distribution(assigned(spark, d), "cluster")


@query("ward_merge_cost", """WITH c AS (SELECT p_brand AS c, count(*) AS n, avg(p_size) AS x, avg(p_retailprice) AS y FROM part GROUP BY 1)
 SELECT a.c AS a, b.c AS b, round(a.n * b.n / (a.n + b.n) * ((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 4) AS cost FROM c a JOIN c b ON a.c < b.c""")
def ward_merge_cost(spark, d):
    return rounded(clustering.ward_merge_cost(table(spark, d, "part"), XY, "p_brand"), 4)


CH_SQL = """, k AS (SELECT cluster, count(*) AS n, avg(p_size) AS mx, avg(p_retailprice) AS my, var_pop(p_size) + var_pop(p_retailprice) AS v FROM a GROUP BY 1),
 o AS (SELECT avg(p_size) AS gx, avg(p_retailprice) AS gy, count(*) AS rows FROM a)"""
# 0 below two clusters
CH = "CASE WHEN count(*) > 1 THEN sum(n * ((mx - gx) ** 2 + (my - gy) ** 2)) / (count(*) - 1) / (sum(n * v) / (max(rows) - count(*))) ELSE 0 END"


@query("calinski_harabasz", f"{NEAREST}{CH_SQL} SELECT count(*) AS clusters, max(rows) AS rows, round({CH}, 2) AS calinski_harabasz FROM k, o")
def calinski_harabasz(spark, d):
    return rounded(metrics.calinski_harabasz(assigned(spark, d), XY, "cluster"), 2)


SILHOUETTE = """, p AS (SELECT x.p_partkey AS id, x.cluster AS own, y.cluster AS other,
  sum(sqrt((x.p_size - y.p_size) ** 2 + (x.p_retailprice - y.p_retailprice) ** 2)) AS t, count(*) AS m FROM a x, a y GROUP BY 1, 2, 3),
 q AS (SELECT id, max(CASE WHEN own = other THEN t / (m - 1) END) AS aa, min(CASE WHEN own <> other THEN t / m END) AS bb FROM p GROUP BY 1)"""


@query("silhouette_exact", f"{NEAREST}{SILHOUETTE} SELECT round(coalesce(avg((bb - aa) / greatest(aa, bb)), 0), 6) AS silhouette FROM q")
def silhouette_exact(spark, d):
    return rounded(metrics.silhouette(assigned(spark, d), XY, "cluster", block_rows=700))


@query("silhouette_squared")
def silhouette_squared(spark, d):
    return metrics.silhouette(assigned(spark, d), XY, "cluster", mode="squared")


@query("cluster_metrics", f"""{NEAREST}{CH_SQL}{SILHOUETTE} SELECT c.*, round(s, 4) AS silhouette FROM
 (SELECT count(*) AS clusters, max(rows) AS rows, round({CH}, 2) AS calinski_harabasz FROM k, o) c, (SELECT coalesce(avg((bb - aa) / greatest(aa, bb)), 0) AS s FROM q)""")
def cluster_metrics(spark, d):
    m = metrics.cluster_metrics(assigned(spark, d), XY, "cluster")
    return m.select("clusters", "rows", F.round("calinski_harabasz", 2).alias("calinski_harabasz"), F.round("silhouette", 4).alias("silhouette"))


# ---- closed forms of one-feature models -------------------------------------

def price_line(spark, d):
    """Quantity and a value that grows with it."""
    rows = table(spark, d, "lineitem").select(F.col("l_quantity").alias("x"), (F.col("l_quantity") * F.col("l_extendedprice") / 100000.0).alias("y"))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)


LINE = """WITH t AS (SELECT l_quantity AS x, l_quantity * l_extendedprice / 100000.0 AS y FROM lineitem),
 m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM t)"""


def line_sql(slope: str) -> str:
    return f"""{LINE}, w AS (SELECT {slope} AS w, mx, my FROM m) SELECT 'x' AS feature, round(w, 4) AS coefficient FROM w
 UNION ALL SELECT 'intercept', round(my - w * mx, 4) FROM w"""


@query("ols_1d", line_sql("sxy / sxx"))
def ols_1d(spark, d):
    rows = price_line(spark, d)
    return rounded(linear.coefficients(linear.linear_regression(rows, "y"), rows, ["x"]), 4)


@query("ridge_1d", line_sql("n * sxy / (n * sxx + 200000.0)"))
def ridge_1d(spark, d):
    rows = price_line(spark, d)
    return rounded(linear.coefficients(linear.ridge(rows, "y", alpha=200000.0), rows, ["x"]), 4)


@query("lasso_1d", line_sql("sign(sxy) * greatest(abs(sxy) - 20.0, 0) / sxx"))
def lasso_1d(spark, d):
    rows = price_line(spark, d)
    return rounded(linear.coefficients(linear.lasso(rows, "y", alpha=20.0), rows, ["x"]), 4)


@query("enet_1d", line_sql("sign(sxy) * greatest(abs(sxy) - 20.0 * 0.5, 0) / (sxx + 20.0 * 0.5)"))
def enet_1d(spark, d):
    rows = price_line(spark, d)
    return rounded(linear.coefficients(linear.elastic_net(rows, "y", alpha=20.0, l1_ratio=0.5), rows, ["x"]), 4)


# ---- single tree steps ------------------------------------------------------

SPLIT = """, g AS (SELECT cast(n_chars AS DOUBLE) AS v, sum({a}) AS a, sum({b}) AS b FROM s GROUP BY 1),
 c AS (SELECT *, sum(a) OVER w AS la, sum(b) OVER w AS lb, sum(a) OVER () AS ta, sum(b) OVER () AS tb, lead(v) OVER w AS nv FROM g WINDOW w AS (ORDER BY v))"""
GINI = "round((2 * (ta / tb) * (1 - ta / tb)) - (lb * 2 * (la / lb) * (1 - la / lb) + (tb - lb) * 2 * ((ta - la) / (tb - lb)) * (1 - (ta - la) / (tb - lb))) / tb, 12)"


@query("best_gini_split", f"""{T_SCORED}{SPLIT.format(a="CAST(y AS DOUBLE)", b="1.0::DOUBLE")} SELECT (v + nv) / 2 AS threshold, round({GINI}, 9) AS gain,
 la AS left_pos, lb - la AS left_neg, ta - la AS right_pos, tb - lb - ta + la AS right_neg FROM c WHERE nv IS NOT NULL ORDER BY {GINI} DESC, threshold LIMIT 1""")
def best_gini_split(spark, d):
    return rounded(trees.best_gini_split(scored(spark, d), "n_chars", "y"), 9)


@query("stump_round", f"""{T_SCORED}{SPLIT.format(a="CAST(y AS DOUBLE)", b="1.0::DOUBLE")},
 b AS (SELECT (v + nv) / 2 AS threshold, la / lb > 0.5 AS lpos, (ta - la) / (tb - lb) > 0.5 AS rpos FROM c WHERE nv IS NOT NULL ORDER BY {GINI} DESC, threshold LIMIT 1),
 w AS (SELECT s.id, CASE WHEN (CASE WHEN n_chars <= threshold THEN lpos ELSE rpos END) <> (y = 1) THEN 1.0 ELSE 0.0 END AS wrong FROM s, b),
 e AS (SELECT avg(wrong) AS e FROM w) SELECT id, wrong::DOUBLE AS wrong, round(e, 6) AS error, round(0.8 * ln((1 - e) / e), 6) AS alpha,
 round(CASE WHEN wrong > 0 THEN exp(0.8 * ln((1 - e) / e)) ELSE 1 END, 6) AS weight FROM w, e""")
def stump_round(spark, d):
    """One AdaBoost round: the stump, its error and weight, and the new row weights."""
    rows = scored(spark, d)
    s = trees.best_gini_split(rows, "n_chars", "y")
    stump = one_row(s.select("threshold", (F.col("left_pos") > F.col("left_neg")).alias("l"), (F.col("right_pos") > F.col("right_neg")).alias("r")))
    guess = F.when(F.col("n_chars") <= F.col("_s.threshold"), F.col("_s.l")).otherwise(F.col("_s.r"))
    marked = rows.withColumn("_s", stump).select("id", (guess != (F.col("y") == 1)).cast("double").alias("wrong"))
    error = one_row(marked.agg(F.avg("wrong").alias("e")))
    alpha = 0.8 * F.ln((1 - F.col("_e.e")) / F.col("_e.e"))
    return rounded(marked.withColumn("_e", error).select("id", "wrong", F.col("_e.e").alias("error"), alpha.alias("alpha"),
                                                         F.when(F.col("wrong") > 0, F.exp(alpha)).otherwise(1.0).alias("weight")))


NEWTON = "round(0.5 * (la * la / (lb + 1) + (ta - la) * (ta - la) / (tb - lb + 1) - ta * ta / (tb + 1)), 9)"


@query("newton_split", f"""{T_SCORED}{SPLIT.format(a="0.5::DOUBLE - y", b="0.25::DOUBLE")} SELECT (v + nv) / 2 AS threshold, round({NEWTON}, 6) AS gain,
 round(-la / (lb + 1), 6) AS left_value, round(-(ta - la) / (tb - lb + 1), 6) AS right_value FROM c WHERE nv IS NOT NULL ORDER BY {NEWTON} DESC, threshold LIMIT 1""")
def newton_split(spark, d):
    return rounded(trees.best_newton_split(scored(spark, d), "n_chars", F.lit(0.5) - F.col("y"), F.lit(0.25)))


# ---- charts -----------------------------------------------------------------

HIST = """SELECT b AS bin, round(lo + b * (hi - lo) / {n}, 6) AS "left", round(lo + (b + 1) * (hi - lo) / {n}, 6) AS "right", coalesce(c, 0) AS "count" FROM
 (SELECT cast(unnest(range({n})) AS INTEGER) AS b), (SELECT min({x}) AS lo, max({x}) AS hi FROM {t}) LEFT JOIN
 (SELECT least(floor(({x} - lo) / (hi - lo) * {n}), {n} - 1) AS k, count(*) AS c FROM {t}, (SELECT min({x}) AS lo, max({x}) AS hi FROM {t}) GROUP BY 1) ON k = b"""


@query("histogram", HIST.format(n=30, x="value", t="events"))
def histogram(spark, d):
    return rounded(charts.histogram(table(spark, d, "events"), "value"))


@query("histogram_by", """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
 h AS (SELECT event_type AS class, least(floor((value - lo) / (hi - lo) * 20), 19) AS k, count(*) AS c FROM events, e GROUP BY 1, 2),
 g AS (SELECT class, b FROM (SELECT DISTINCT event_type AS class FROM events), (SELECT cast(unnest(range(20)) AS INTEGER) AS b))
 SELECT g.class, b AS bin, round(lo + b * (hi - lo) / 20, 6) AS "left", round(lo + (b + 1) * (hi - lo) / 20, 6) AS "right", coalesce(c, 0) AS "count"
 FROM g CROSS JOIN e LEFT JOIN h ON h.class = g.class AND k = b""")
def histogram_by(spark, d):
    return rounded(charts.histogram(table(spark, d, "events"), "value", 20, "event_type"))


@query("scaled_histograms", f"""WITH z AS (SELECT (c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER () AS z FROM customer)
 SELECT bin, round("left", 4) AS "left", round("right", 4) AS "right", "count", stage FROM (
 SELECT *, 'before' AS stage FROM ({HIST.format(n=25, x="c_acctbal", t="customer")}) UNION ALL SELECT *, 'after' FROM ({HIST.format(n=25, x="z", t="z")}))""")
def scaled_histograms(spark, d):
    return rounded(charts.scaled_histograms(table(spark, d, "customer"), "c_acctbal"), 4)


@query("kde", """WITH e AS (SELECT count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) ** -0.2 * stddev_samp(l_extendedprice) AS h FROM lineitem),
 g AS (SELECT cast(i AS INTEGER) AS i, lo + i * (hi - lo) / 39 AS x FROM e, (SELECT unnest(range(40)) AS i))
 SELECT i, round(x, 4) AS x, round(sum(exp(-(((x - l_extendedprice) / h) ** 2) / 2)) / (max(n) * max(h) * sqrt(2 * pi())) * 1e6, 6) AS density FROM lineitem, g, e GROUP BY 1, 2""")
def kde(spark, d):
    k = charts.kde(table(spark, d, "lineitem"), "l_extendedprice", 40)
    return k.select("i", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density"))


BOX = """WITH q AS (SELECT event_type AS class, quantile_cont(value, 0.25) AS q1, median(value) AS m, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
 SELECT class, round(q1, 4) AS q1, round(m, 4) AS median, round(q3, 4) AS q3,
 min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker,
 max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker,
 count(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers FROM events JOIN q ON event_type = class GROUP BY class, q1, m, q3"""


@query("box_stats", BOX)
def box_stats(spark, d):
    return rounded(charts.box_stats(table(spark, d, "events"), "value", "event_type"), 4)


@query("box_stats_bucketed", BOX)
def box_stats_bucketed(spark, d):
    """Exact quartiles by order buckets, the way big tables get them."""
    return rounded(charts.box_stats(table(spark, d, "events"), "value", "event_type", buckets=64), 4)


@query("pie_share", """SELECT o_orderpriority AS class, count(*) AS "count", round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM orders GROUP BY 1""")
def pie_share(spark, d):
    return rounded(charts.bar_data(table(spark, d, "orders"), "o_orderpriority")).drop("label")


@query("scatter_sample", f"""WITH t AS (SELECT o_orderkey, o_totalprice AS actual, 0.9 * o_totalprice + 1000 AS predicted FROM orders ORDER BY {md5("o_orderkey")} LIMIT 500)
 SELECT o_orderkey, actual, round(predicted, 4) AS predicted, round(min(least(actual, predicted)) OVER (), 4) AS line_low, round(max(greatest(actual, predicted)) OVER (), 4) AS line_high FROM t""")
def scatter_sample(spark, d):
    rows = table(spark, d, "orders").withColumn("p", F.lit(0.9) * F.col("o_totalprice") + 1000)
    return rounded(charts.scatter_sample(rows, ["o_orderkey"], "o_totalprice", "p"), 4)


@query("probability_curve", f"""{T_SCORED}, r AS (SELECT id, score, y, row_number() OVER (ORDER BY score, id) AS r, count(*) OVER () AS n FROM s)
 SELECT id, r AS "rank", round(-5 + 10.0 * (r - 1) / (n - 1), 6) AS x, score, CASE WHEN (r - 1) % 25 = 0 THEN y END AS class FROM r""")
def probability_curve(spark, d):
    return rounded(charts.sorted_probability_curve(scored(spark, d), "id", "score", "y"))


@query("split_bars", f"""WITH p AS (SELECT CASE WHEN row_number() OVER (ORDER BY {md5("o_orderkey")}) <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS part FROM orders)
 SELECT part AS class, count(*) AS "count", round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM p GROUP BY 1""")
def split_bars(spark, d):
    return rounded(charts.split_bar_data(splits.train_test_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])))


@query("quantiles_bucketed", "WITH " + cte("t", ITEMS, "lineitem") + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, round(q1 - 1.5 * (q3 - q1), 4) AS low,
 round(q3 + 1.5 * (q3 - q1), 4) AS high, count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1)) AS below, count(*) FILTER (WHERE {c} > q3 + 1.5 * (q3 - q1)) AS above,
 count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1)) + count(*) FILTER (WHERE {c} > q3 + 1.5 * (q3 - q1)) AS outliers
 FROM t, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM t) GROUP BY q1, q3""" for c in ("quantity", "discount", "tax")))
def quantiles_bucketed(spark, d):
    return rounded(statistics.iqr_bounds(items(spark, d), ["quantity", "discount", "tax"], buckets=16), 4)
