"""Running values, ranks, samples, set operations and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import bin_index, clip, expected_improvement, linear_score, normal_cdf, normal_pdf, sigmoid
from ..operators import joins, search, splits, windows
from ..runtime import one_row
from . import query, table
from .shared import rounded, scored, SCORED

MONTHS = """SELECT cast(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS period, count(*) AS orders,
 round(avg(o_totalprice), 2) AS mean_price FROM orders GROUP BY 1"""


def months(spark, d):
    orders = table(spark, d, "orders")
    return orders.groupBy((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("period")).agg(
        F.count("*").alias("orders"), F.round(F.avg("o_totalprice"), 2).alias("mean_price"))


def md5(key: str, seed: int = 42) -> str:
    return f"md5('{seed}-' || cast({key} AS VARCHAR))"


def uniform(key: str, seed: int = 42) -> str:
    return f"(cast(('0x' || substr({md5(key, seed)}, 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE)"


# ---- running values ---------------------------------------------------------

@query("running_max", f"""SELECT period, mean_price, max(mean_price) OVER (ORDER BY period) AS best FROM ({MONTHS})""")
def running_max(spark, d):
    return windows.running_max(months(spark, d).select("period", "mean_price"), "period", "mean_price")


@query("running_sum", f"""SELECT period, orders, cast(sum(orders) OVER (ORDER BY period) AS BIGINT) AS cumulative FROM ({MONTHS})""")
def running_sum(spark, d):
    return windows.running_sum(months(spark, d).select("period", "orders"), "period", "orders")


@query("running_sum_events", """SELECT event_id, round(sum(value) OVER (ORDER BY event_id), 2) AS cumulative FROM events""")
def running_sum_events(spark, d):
    """The bucketed path, forced: a global running sum over every row."""
    rows = table(spark, d, "events").select("event_id", "value")
    return rounded(windows.running_sum(rows, "event_id", "value", buckets=64).drop("value"), 2)


@query("first_at_least", f"""SELECT min(period) AS period FROM (SELECT period, sum(orders) OVER (ORDER BY period) AS c,
 sum(orders) OVER () AS total FROM ({MONTHS})) WHERE c >= 0.95 * total""")
def first_at_least(spark, d):
    cumulative = windows.running_sum(months(spark, d).select("period", "orders"), "period", "orders")
    total = one_row(months(spark, d).agg(F.sum("orders").alias("t")))
    share = cumulative.withColumn("_t", total).withColumn("share", F.col("cumulative") / F.col("_t.t"))
    return windows.first_at_least(share, "period", "share", 0.95)


EVERY_SQL = """SELECT o_orderkey, o_totalprice, "rank" FROM (SELECT o_orderkey, o_totalprice,
 row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS "rank" FROM orders) WHERE ("rank" - 1) % 25 = 0"""


@query("every_nth", EVERY_SQL)
def every_nth(spark, d):
    return windows.every_nth(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("row_index", """SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (ORDER BY l_quantity, k) AS "index" FROM
 (SELECT l_orderkey, l_partkey, l_quantity, l_orderkey * 100000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber AS k FROM lineitem)""")
def row_index(spark, d):
    """Few distinct values of the order column, so most of the work is ranking copies; the bucketed path, forced."""
    rows = table(spark, d, "lineitem").withColumn(
        "k", F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey") * 10 + F.col("l_linenumber"))
    ranked = windows.row_index(rows.select("l_orderkey", "l_partkey", "l_quantity", "k"), "l_quantity", "k", buckets=32)
    return ranked.drop("k")


@query("rank_within", f"""SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5("o_orderkey")}) AS "rank",
 count(*) OVER (PARTITION BY o_orderstatus) AS group_rows FROM orders""")
def rank_within(spark, d):
    return windows.rank_within(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], ["o_orderkey"])


# ---- order, top, samples ----------------------------------------------------

@query("sort_by", "SELECT c_custkey, c_acctbal FROM customer")
def sort_by(spark, d):
    return windows.sort_by(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark, d):
    return windows.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20, ["o_orderkey"])


@query("head_by", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 50")
def head_by(spark, d):
    return windows.head_by(table(spark, d, "events").select("event_id", "value"), ["event_id"], 50)


@query("arg_best", """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
 (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def arg_best(spark, d):
    return windows.arg_best(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", ["o_custkey"])


@query("reservoir", f"SELECT event_id, value FROM events ORDER BY {md5('event_id', 7)} LIMIT 200")
def reservoir(spark, d):
    return windows.reservoir_sample(table(spark, d, "events").select("event_id", "value"), 200, ["event_id"])


@query("sample_n", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {md5('o_orderkey')} LIMIT 500")
def sample_n(spark, d):
    return windows.sample_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 500, ["o_orderkey"])


# ---- sets -------------------------------------------------------------------

@query("union_ragged", """SELECT 'customer' AS source, avg_balance, NULL::DOUBLE AS avg_price FROM (SELECT round(avg(c_acctbal), 4) AS avg_balance FROM customer)
 UNION ALL SELECT 'orders', NULL, round(avg(o_totalprice), 4) FROM orders""")
def union_ragged(spark, d):
    a = table(spark, d, "customer").agg(F.round(F.avg("c_acctbal"), 4).alias("avg_balance")).withColumn("source", F.lit("customer"))
    b = table(spark, d, "orders").agg(F.round(F.avg("o_totalprice"), 4).alias("avg_price")).withColumn("source", F.lit("orders"))
    return windows.union_results(a, b)


@query("distinct_values", "SELECT DISTINCT l_discount AS \"value\" FROM lineitem")
def distinct_values(spark, d):
    return windows.distinct_values(table(spark, d, "lineitem"), "l_discount")


@query("distinct_subset", "SELECT bool_and(quality IN (0, 1)) AS within FROM labels")
def distinct_subset(spark, d):
    return windows.values_within(table(spark, d, "labels"), "quality", [0, 1])


@query("noise_excluded", """WITH t AS (SELECT CASE WHEN value > 30 THEN -1 ELSE cast(floor(value / 10) AS INTEGER) END AS c FROM events)
 SELECT count(DISTINCT c) FILTER (WHERE c <> -1) AS clusters, count(*) FILTER (WHERE c = -1) AS noise_rows FROM t""")
def noise_excluded(spark, d):
    rows = table(spark, d, "events").selectExpr("CASE WHEN value > 30 THEN -1 ELSE cast(floor(value / 10) AS INT) END AS c")
    return windows.label_count(rows, "c")


# ---- joins ------------------------------------------------------------------

@query("attach_by_id", """SELECT o_orderkey, c_custkey, c_mktsegment, c_acctbal FROM (SELECT o_orderkey, o_custkey AS c_custkey FROM orders)
 LEFT JOIN customer USING (c_custkey)""")
def attach_by_id(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return joins.attach_by_id(orders, table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), "c_custkey")


@query("column_concat", "SELECT l_orderkey, l_linenumber, l_quantity * l_discount AS a, l_quantity + l_tax AS b FROM lineitem")
def column_concat(spark, d):
    rows = table(spark, d, "lineitem")
    return joins.column_concat(rows, a=F.col("l_quantity") * F.col("l_discount"), b=F.col("l_quantity") + F.col("l_tax")).select(
        "l_orderkey", "l_linenumber", "a", "b")


CENTERS = [(10.0, 950.0), (25.0, 1000.0), (40.0, 1080.0)]


@query("center_distances", " UNION ALL ".join(
    f"SELECT p_partkey, round(sqrt((p_size - {x}) ** 2 + (p_retailprice - {y}) ** 2), 6) AS distance, {i} AS center FROM part"
    for i, (x, y) in enumerate(CENTERS)))
def center_distances(spark, d):
    return rounded(joins.center_distances(table(spark, d, "part"), ["p_partkey"], ["p_size", "p_retailprice"], CENTERS))


NEAREST = "WITH n AS (" + " UNION ALL ".join(
    f"SELECT p_partkey, p_size, p_retailprice, sqrt((p_size - {x}) ** 2 + (p_retailprice - {y}) ** 2) AS distance, {i} AS cluster FROM part"
    for i, (x, y) in enumerate(CENTERS)) + """), a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY distance, cluster) AS r FROM n) WHERE r = 1)"""


@query("distance_join", f"{NEAREST} SELECT p_partkey, cluster, round(distance, 6) AS distance FROM a")
def distance_join(spark, d):
    near = joins.distance_join(table(spark, d, "part"), ["p_size", "p_retailprice"], CENTERS)
    return rounded(near.select("p_partkey", "cluster", "distance"))


@query("radius_pairs", """SELECT a.p_partkey AS src, b.p_partkey AS dst, round(sqrt((a.p_size - b.p_size) ** 2 + (a.p_retailprice - b.p_retailprice) ** 2), 6) AS distance
 FROM part a JOIN part b ON a.p_partkey < b.p_partkey WHERE sqrt((a.p_size - b.p_size) ** 2 + (a.p_retailprice - b.p_retailprice) ** 2) <= 0.65""")
def radius_pairs(spark, d):
    return rounded(joins.radius_join(table(spark, d, "part"), "p_partkey", ["p_size", "p_retailprice"], 0.65))


DIST64 = "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query("knn_exact", f"""SELECT src, dst, round(distance, 6) AS distance, r AS "rank" FROM (
 SELECT a.vec_id AS src, b.vec_id AS dst, {DIST64} AS distance,
  cast(row_number() OVER (PARTITION BY a.vec_id ORDER BY {DIST64}, b.vec_id) AS INTEGER) AS r
 FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE r <= 5""")
def knn_exact(spark, d):
    return rounded(joins.knn_join(table(spark, d, "embeddings"), "vec_id", "embedding", 5))


# ---- scalar functions -------------------------------------------------------

STAND = "(value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events)"
ERF = """(sign(x) * (1 - (((((1.061405429 * t - 1.453152027) * t) + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * exp(-x * x)))"""


@query("normal_ei", f"""WITH z AS (SELECT event_id, {STAND} AS z FROM events),
 e AS (SELECT event_id, z, z / sqrt(2.0) AS x, 1 / (1 + 0.3275911 * abs(z / sqrt(2.0))) AS t FROM z),
 c AS (SELECT event_id, z, exp(-z * z / 2) / sqrt(2 * pi()) AS pdf, 0.5 * (1 + {ERF}) AS cdf FROM e),
 g AS (SELECT event_id, (z - 0.2 - 0.01) AS gain, (z - 0.2 - 0.01) / 0.5 AS w FROM c),
 h AS (SELECT event_id, gain, w, w / sqrt(2.0) AS x, 1 / (1 + 0.3275911 * abs(w / sqrt(2.0))) AS t FROM g)
 SELECT event_id, round(pdf, 6) AS pdf, round(cdf, 6) AS cdf,
  round(gain * 0.5 * (1 + {ERF}) + 0.5 * exp(-w * w / 2) / sqrt(2 * pi()), 6) AS ei FROM c JOIN h USING (event_id)""")
def normal_ei(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    stats = one_row(events.agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s")))
    z = events.withColumn("_s", stats).withColumn("z", (F.col("value") - F.col("_s.m")) / F.col("_s.s"))
    return rounded(z.select("event_id", normal_pdf("z").alias("pdf"), normal_cdf("z").alias("cdf"),
                            expected_improvement("z", F.lit(0.5), F.lit(0.2)).alias("ei")))


@query("scalar_math", """SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(0.5 + 0.1 * l_quantity - 20 * l_discount))), 6) AS p,
 CASE WHEN l_quantity < 10 THEN 10.0::DOUBLE WHEN l_quantity > 40 THEN 40.0::DOUBLE ELSE l_quantity END AS clipped,
 cast(least(floor((l_quantity - 1) / 49.0 * 8), 7) AS BIGINT) AS bin FROM lineitem""")
def scalar_math(spark, d):
    return rounded(table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", sigmoid(linear_score({"l_quantity": 0.1, "l_discount": -20.0}, 0.5)).alias("p"),
        clip("l_quantity", 10.0, 40.0).alias("clipped"), bin_index("l_quantity", F.lit(1.0), F.lit(50.0), 8).alias("bin")))


# ---- splits -----------------------------------------------------------------

@query("split_random", f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {md5("o_orderkey")}) <= ceil(count(*) OVER () * 0.2)
 THEN 'test' ELSE 'train' END AS part FROM orders""")
def split_random(spark, d):
    return splits.train_test_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


@query("split_hash", f"SELECT o_orderkey, CASE WHEN {uniform('o_orderkey')} < 0.2 THEN 'test' ELSE 'train' END AS part FROM orders")
def split_hash(spark, d):
    return splits.train_test_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], mode="hash")


@query("split_stratified", f"""WITH c AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1),
 q AS (SELECT s, n, n * w / a AS share, floor(n * w / a) AS whole FROM c, (SELECT sum(n) AS a, ceil(sum(n) * 0.2) AS w FROM c)),
 r AS (SELECT s, whole + CASE WHEN row_number() OVER (ORDER BY share - whole DESC, s) <= (SELECT ceil(sum(n) * 0.2) FROM c) - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM q)
 SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5("o_orderkey")}) <= quota THEN 'test' ELSE 'train' END AS part
 FROM orders JOIN r ON o_orderstatus = s""")
def split_stratified(spark, d):
    return splits.stratified_split(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"])


@query("kfold_assign", f"""SELECT o_orderkey, cast((row_number() OVER (ORDER BY {md5("o_orderkey")}) - 1) % 5 AS INTEGER) AS fold FROM orders""")
def kfold_assign(spark, d):
    return splits.kfold(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


# ---- candidates: their bounds come from the data ----------------------------

def _bounds(df, column):
    row = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    return row["lo"], row["hi"]


@query("param_grid", """WITH b AS (SELECT cast(min(l_quantity) AS DOUBLE) AS a0, cast(max(l_quantity) AS DOUBLE) AS a1,
  min(l_discount) AS b0, max(l_discount) AS b1 FROM lineitem),
 x AS (SELECT a0 + (a1 - a0) * i / 4.0 AS quantity, i FROM b, range(5) r(i)), y AS (SELECT b0 + (b1 - b0) * i / 2.0 AS discount, i AS j FROM b, range(3) r(i))
 SELECT cast(i * 6 + j * 2 + k + 1 AS INTEGER) AS trial, round(quantity, 6) AS quantity, round(discount, 6) AS discount, ['low', 'high'][k + 1] AS tax
 FROM x, y, range(2) r(k)""")
def param_grid(spark, d):
    rows = table(spark, d, "lineitem")
    (a0, a1), (b0, b1) = _bounds(rows, "l_quantity"), _bounds(rows, "l_discount")
    return rounded(search.param_grid(spark, {"quantity": [a0 + (a1 - a0) * i / 4.0 for i in range(5)],
                                             "discount": [b0 + (b1 - b0) * i / 2.0 for i in range(3)], "tax": ["low", "high"]}))


@query("random_candidates", f"""WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders)
 SELECT cast(t AS INTEGER) AS trial, round(lo + (hi - lo) * {uniform("t", 42000)}, 4) AS price,
  list_extract([0, 1, 2, 3], cast(floor({uniform("t", 42001)} * 4) AS INTEGER) + 1) AS choice FROM b, (SELECT unnest(range(1, 26)) AS t)""")
def random_candidates(spark, d):
    bounds = _bounds(table(spark, d, "orders"), "o_totalprice")
    return rounded(search.random_candidates(spark, 25, {"price": bounds, "choice": [0, 1, 2, 3]}), 4)


@query("surface", """WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, avg(l_quantity * l_quantity) AS xx,
  avg(l_quantity * l_extendedprice) AS xy, avg(l_extendedprice * l_extendedprice) AS yy, max(l_extendedprice) AS top FROM lineitem),
 g AS (SELECT (top / 10) * a / 19.0 AS x, (top / 20) * b / 19.0 AS y FROM m, range(20) p(a), range(20) q(b))
 SELECT round(x, 2) AS x, round(y, 2) AS y, round((yy - 2 * x * my - 2 * y * xy + x * x + 2 * x * y * mx + y * y * xx) / 1e6, 2) AS z FROM g, m""")
def surface(spark, d):
    """Mean squared error of price = x + y * quantity over a mesh, from the table's moments."""
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    m = table(spark, d, "lineitem").agg(F.avg(q).alias("mx"), F.avg(p).alias("my"), F.avg(q * q).alias("xx"), F.avg(q * p).alias("xy"),
                                        F.avg(p * p).alias("yy"), F.max(p).alias("top")).first()

    def loss(x, y):
        return (m["yy"] - 2 * x * m["my"] - 2 * y * m["xy"] + x * x + 2 * x * y * m["mx"] + y * y * m["xx"]) / 1e6

    return rounded(search.surface(spark, (0.0, m["top"] / 10), (0.0, m["top"] / 20), loss, 20), 2)


TRIALS = [(1, 0.1), (2, 0.3), (3, 0.5), (4, 0.7), (5, 0.9)]
FOLDED = f"""WITH s AS ({SCORED}), f AS (SELECT *, cast((row_number() OVER (ORDER BY {md5("id")}) - 1) % 5 AS INTEGER) AS fold FROM s),
 g AS (SELECT unnest([1, 2, 3, 4, 5]) AS trial, unnest([0.1, 0.3, 0.5, 0.7, 0.9]) AS cutoff),
 e AS (SELECT trial, fold, avg(CASE WHEN (score > cutoff::DOUBLE) = (y = 1) THEN 1.0 ELSE 0.0 END) AS score FROM f, g GROUP BY 1, 2)"""


def cutoff_scores(spark, d):
    """Accuracy of five cutoffs of a score, per fold: the trials and the (trial, fold, score) rows."""
    folded = splits.kfold(scored(spark, d), ["id"])
    cutoffs = F.explode(F.array(*[F.struct(F.lit(t).alias("trial"), F.lit(c).alias("cutoff")) for t, c in TRIALS]))
    hit = ((F.col("score") > F.col("c.cutoff")) == (F.col("y") == 1)).cast("double")
    scores = folded.withColumn("c", cutoffs).groupBy("c.trial", "fold").agg(F.avg(hit).alias("score"))
    return spark.createDataFrame(TRIALS, "trial int, cutoff double"), scores


TRIAL_SQL = f"""{FOLDED}, w AS (SELECT trial, {", ".join(f"round(avg(score) FILTER (WHERE fold = {i}), 4) AS fold_{i + 1}" for i in range(5))},
 round(avg(score), 4) AS mean_score FROM e GROUP BY 1)"""


@query("trial_table", f"{TRIAL_SQL} SELECT trial, cutoff::DOUBLE AS cutoff, mean_score, fold_1, fold_2, fold_3, fold_4, fold_5 FROM w JOIN g USING (trial)")
def trial_table(spark, d):
    return search.trial_table(*cutoff_scores(spark, d), 5)


@query("best_trial", f"""{TRIAL_SQL} SELECT trial, cutoff::DOUBLE AS cutoff, mean_score, fold_1, fold_2, fold_3, fold_4, fold_5
 FROM w JOIN g USING (trial) ORDER BY mean_score DESC, trial LIMIT 1""")
def best_trial(spark, d):
    return search.best_trial(search.trial_table(*cutoff_scores(spark, d), 5))


@query("convergence", f"""{TRIAL_SQL} SELECT 'cutoff' AS "method", trial, mean_score, max(mean_score) OVER (ORDER BY trial) AS best_so_far FROM w""")
def convergence(spark, d):
    trials = search.trial_table(*cutoff_scores(spark, d), 5).select(F.lit("cutoff").alias("method"), "trial", "mean_score")
    return search.convergence(trials)


@query("search_summary", f"""{TRIAL_SQL} SELECT 'cutoff' AS "method", max(mean_score) AS best_score, count(*) AS evaluations, 5 AS folds FROM w""")
def search_summary(spark, d):
    return search.search_summary(spark, {"cutoff": search.trial_table(*cutoff_scores(spark, d), 5)}, 5)
