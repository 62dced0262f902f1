"""Profiling, cleaning and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import format_cell, format_count, row_count, row_mean, row_std, row_sum, safe_name, slug, strip_lower, strip_prefix
from ..operators import cleaning, columns, features, joins, prep, reduction, statistics
from . import query, table
from .shared import ITEMS, MESSY_ORDERS, READINGS, cte, items, messy_orders, readings, rounded

T_ITEMS = "WITH " + cte("t", ITEMS, "lineitem")
T_READ = "WITH " + cte("t", READINGS, "events")
T_MESSY = "WITH " + cte("t", MESSY_ORDERS, "orders")
ITEM_COLUMNS = ["line", "quantity", "discount", "tax", "flag", "status", "nothing", "constant"]
ITEM_NUMBERS = ["line", "quantity", "discount", "tax", "nothing", "constant"]


def each(cols, template: str) -> str:
    """UNION ALL of one SELECT per column."""
    return " UNION ALL ".join(template.format(c=c) for c in cols)


GAPS = " + ".join(f"count(*) - count({c})" for c in ITEM_COLUMNS)


# ---- statistics -------------------------------------------------------------

@query("dataset_info", f"""{T_ITEMS} SELECT count(*) AS rows, cast(8 AS INTEGER) AS columns,
 cast({GAPS} AS BIGINT) AS missing_cells,
 cast(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS BIGINT) AS duplicate_rows,
 '{",".join(ITEM_COLUMNS)}' AS column_names, '{",".join(ITEM_NUMBERS)}' AS numeric_columns,
 'flag,status' AS categorical_columns FROM t""")
def dataset_info(spark, d):
    return statistics.dataset_info(items(spark, d))


DESCRIBE_SQL = """SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean,
 round(stddev_samp({c}), 4) AS std, cast(min({c}) AS DOUBLE) AS "min",
 round(quantile_cont(cast({c} AS DOUBLE), 0.25), 4) AS p25, round(quantile_cont(cast({c} AS DOUBLE), 0.5), 4) AS p50,
 round(quantile_cont(cast({c} AS DOUBLE), 0.75), 4) AS p75, cast(max({c}) AS DOUBLE) AS "max" FROM t"""


@query("describe_numeric", f"{T_ITEMS} {each(ITEM_NUMBERS, DESCRIBE_SQL)}")
def describe_numeric(spark, d):
    return rounded(statistics.describe(items(spark, d)), 4)


MISSING_SQL = """SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
 round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_percent FROM t"""


@query("missing_summary", f"{T_ITEMS} {each(ITEM_COLUMNS, MISSING_SQL)}")
def missing_summary(spark, d):
    return rounded(statistics.missing_summary(items(spark, d)))


@query("missing_summary_sorted", f"{T_ITEMS} SELECT * FROM ({each(ITEM_COLUMNS, MISSING_SQL)}) WHERE missing_count > 0")
def missing_summary_sorted(spark, d):
    return rounded(statistics.missing_summary(items(spark, d), only_missing=True))


@query("categorical_summary", f"""{T_ITEMS} {each(["flag", "status"],
 "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values, count(*) - count({c}) AS missing_values FROM t")}""")
def categorical_summary(spark, d):
    return statistics.categorical_summary(items(spark, d))


COUNTS_SQL = """SELECT '{c}' AS "column", coalesce(cast({c} AS VARCHAR), 'nan') AS "value", count(*) AS "count"
 FROM events GROUP BY 2"""


@query("value_counts_top", """WITH c AS (
 SELECT 'kind' AS "column", coalesce(nullif(event_type, 'click'), 'nan') AS "value", count(*) AS "count" FROM events GROUP BY 2
 UNION ALL SELECT 'user_id', cast(user_id AS VARCHAR), count(*) FROM events GROUP BY 2),
 r AS (SELECT *, cast(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, "value") AS INTEGER) AS "rank" FROM c)
 SELECT * FROM r WHERE "rank" <= 15""")
def value_counts_top(spark, d):
    return statistics.value_counts(readings(spark, d), ["kind", "user_id"], 15)


@query("value_counts_all", f"""{T_ITEMS} {each(["flag", "status"],
 "SELECT '{c}' AS \"column\", coalesce({c}, 'nan') AS \"value\", count(*) AS \"count\" FROM t GROUP BY 2")}""")
def value_counts_all(spark, d):
    return statistics.value_counts(items(spark, d), ["flag", "status"], None)


@query("class_distribution", """SELECT o_orderstatus AS class, count(*) AS "count",
 round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM orders GROUP BY 1""")
def class_distribution(spark, d):
    return rounded(statistics.class_distribution(table(spark, d, "orders"), "o_orderstatus"))


@query("group_mean", """SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean_c_acctbal FROM customer GROUP BY 1""")
def group_mean(spark, d):
    return rounded(statistics.group_mean(table(spark, d, "customer"), ["c_mktsegment"], ["c_acctbal"]), 4)


@query("column_means", f"""{T_ITEMS} {each(["line", "quantity", "discount", "tax"],
 "SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean FROM t")}""")
def column_means(spark, d):
    return rounded(statistics.column_means(items(spark, d), ["line", "quantity", "discount", "tax"]), 4)


CORR = ["line", "quantity", "discount", "tax"]


@query("correlation_long", f"""{T_ITEMS} {" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr(cast({a} AS DOUBLE), cast({b} AS DOUBLE)), 6) AS r FROM t"
    for a in CORR for b in CORR)}""")
def correlation_long(spark, d):
    return rounded(statistics.correlation_matrix(items(spark, d), CORR))


IQR_SQL = """SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high,
 count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1)) AS below, count(*) FILTER (WHERE {c} > q3 + 1.5 * (q3 - q1)) AS above
 FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem) GROUP BY q1, q3"""


@query("iqr_outliers", f"""SELECT "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr, round(low, 4) AS low,
 round(high, 4) AS high, below, above, below + above AS outliers FROM ({each(["l_extendedprice", "l_quantity", "l_discount"], IQR_SQL)}
 UNION ALL {IQR_SQL.replace("lineitem", "events").format(c="value")})""")
def iqr_outliers(spark, d):
    a = statistics.iqr_bounds(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"])
    b = statistics.iqr_bounds(table(spark, d, "events"), ["value"])
    return rounded(a.unionByName(b), 4)


@query("dedup_analysis", f"""{T_ITEMS} SELECT n AS total_rows, u AS unique_rows, n - u AS duplicate_rows,
 round(u * 100.0 / n, 6) AS retention_percent FROM (SELECT count(*) AS n FROM t), (SELECT count(*) AS u FROM (SELECT DISTINCT * FROM t))""")
def dedup_analysis(spark, d):
    return rounded(statistics.dedup_analysis(items(spark, d)))


@query("missing_rate", f"""{T_ITEMS} SELECT cast({GAPS} AS BIGINT) AS missing_cells, count(*) * 8 AS cells,
 round(({GAPS}) * 100.0 / (count(*) * 8), 6) AS missing_rate FROM t""")
def missing_rate(spark, d):
    return rounded(statistics.missing_rate(items(spark, d)))


@query("gini", """SELECT cast(sum(n) AS BIGINT) AS total, count(*) AS classes,
 round(1 - sum(n * n) / cast(sum(n) * sum(n) AS DOUBLE), 8) AS gini
 FROM (SELECT cast(count(*) AS DOUBLE) AS n FROM orders GROUP BY o_orderstatus)""")
def gini(spark, d):
    return rounded(statistics.gini_impurity(table(spark, d, "orders"), "o_orderstatus"), 8)


@query("summary_stats", f"""{T_ITEMS} {each(["quantity", "discount"],
 "SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, "
 "min({c}) AS \"min\", max({c}) AS \"max\" FROM t")}""")
def summary_stats(spark, d):
    return rounded(statistics.summary_stats(items(spark, d), ["quantity", "discount"]), 4)


@query("count_distinct", each(["l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"],
                              "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values FROM lineitem"))
def count_distinct(spark, d):
    return statistics.count_distinct(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"])


@query("covariance_2x2", """SELECT count(*) AS n, round(avg(p_size), 4) AS mean_a, round(avg(p_retailprice), 4) AS mean_b,
 round(var_samp(p_size), 4) AS var_a, round(var_samp(p_retailprice), 4) AS var_b,
 round(covar_samp(p_size, p_retailprice), 4) AS cov_ab FROM part""")
def covariance_2x2(spark, d):
    return rounded(statistics.covariance_2x2(table(spark, d, "part"), "p_size", "p_retailprice"), 4)


@query("covariance_pca2", """WITH s AS (SELECT avg(p_size) AS ma, avg(p_retailprice) AS mb, var_samp(p_size) AS va,
  var_samp(p_retailprice) AS vb, covar_samp(p_size, p_retailprice) AS c FROM part),
 e AS (SELECT *, (va + vb) / 2 + sqrt((va - vb) * (va - vb) / 4 + c * c) AS l1,
  (va + vb) / 2 - sqrt((va - vb) * (va - vb) / 4 + c * c) AS l2 FROM s),
 v AS (SELECT *, (l1 - vb) / sqrt((l1 - vb) * (l1 - vb) + c * c) AS x0, c / sqrt((l1 - vb) * (l1 - vb) + c * c) AS y0 FROM e),
 u AS (SELECT *, x0 * CASE WHEN abs(x0) >= abs(y0) THEN sign(x0) ELSE sign(y0) END AS x,
  y0 * CASE WHEN abs(x0) >= abs(y0) THEN sign(x0) ELSE sign(y0) END AS y FROM v)
 SELECT p_partkey, round((p_size - ma) * x + (p_retailprice - mb) * y, 4) AS pc1,
  round((-(p_size - ma) * y + (p_retailprice - mb) * x) * CASE WHEN abs(y) >= abs(x) THEN sign(-y) ELSE sign(x) END, 4) AS pc2,
  round(l1 / (l1 + l2), 4) AS share1, round(l2 / (l1 + l2), 4) AS share2 FROM part, u""")
def covariance_pca2(spark, d):
    return rounded(reduction.pca_2col(table(spark, d, "part"), "p_size", "p_retailprice", ["p_partkey"]), 4)


@query("run_profile")
def run_profile(spark, d):
    parts = statistics.run_profile(items(spark, d), "status")
    counted = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("part"), "rows") for n, t in parts.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


# ---- columns ----------------------------------------------------------------

@query("normalize_column_names", "SELECT c_custkey AS \"customer key\", c_acctbal AS balance FROM customer")
def normalize_column_names(spark, d):
    messy = table(spark, d, "customer").select(F.col("c_custkey").alias(" customer\nkey "), F.col("c_acctbal").alias("balance  "))
    return columns.normalize_column_names(messy)


@query("select_features", "SELECT p_size, p_retailprice FROM part")
def select_features(spark, d):
    return columns.select_features(table(spark, d, "part"), ["p_size", "p_weight", "p_retailprice", "p_brand"], "p_brand")


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_columns(spark, d):
    return columns.drop_columns(table(spark, d, "customer"), ["c_name", "c_acctbal", "c_nickname"])


@query("remove_empty_columns", f"{T_ITEMS} SELECT line, quantity, discount, tax, flag, status, constant FROM t")
def remove_empty_columns(spark, d):
    return columns.remove_empty_columns(items(spark, d))


@query("filter_not_null", f"{T_ITEMS} SELECT line, quantity, flag FROM t WHERE quantity IS NOT NULL AND flag IS NOT NULL")
def filter_not_null(spark, d):
    return columns.filter_not_null(items(spark, d).select("line", "quantity", "flag"), ["quantity", "flag"])


@query("safe_numeric", """SELECT event_id, try_cast(nullif(regexp_extract(props, '[0-9]+'), '7') AS DOUBLE) AS k,
 coalesce(try_cast(event_type AS DOUBLE), 0.0) AS coded, cast(1.5 AS DOUBLE) AS absent FROM events""")
def safe_numeric(spark, d):
    raw = table(spark, d, "events").select(
        "event_id", F.nullif(F.regexp_extract("props", "[0-9]+", 0), F.lit("7")).alias("k"), F.col("event_type").alias("coded"))
    return columns.safe_numeric(columns.safe_numeric(columns.safe_numeric(raw, "k"), "coded", 0.0), "absent", 1.5)


@query("filter_equals", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_equals(spark, d):
    return columns.filter_equals(table(spark, d, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_totalprice")


@query("rename_columns", "SELECT s_suppkey AS supplier, s_acctbal AS balance, s_nationkey, s_name FROM supplier")
def rename_columns(spark, d):
    return columns.rename_columns(table(spark, d, "supplier"), {"s_suppkey": "supplier", "s_acctbal": "balance"})


@query("cast_columns", "SELECT l_orderkey, l_linenumber, cast(l_quantity AS INTEGER) AS l_quantity, cast(l_partkey AS VARCHAR) AS l_partkey FROM lineitem")
def cast_columns(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    return columns.cast(rows, {"l_quantity": "int", "l_partkey": "string"})


@query("wide_to_long", """SELECT l_orderkey, l_linenumber, 'l_discount' AS "column", l_discount AS "value" FROM lineitem
 UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def wide_to_long(spark, d):
    return columns.wide_to_long(table(spark, d, "lineitem"), ["l_discount", "l_tax"], ["l_orderkey", "l_linenumber"])


@query("fill_constant", f"{T_ITEMS} SELECT coalesce(quantity, 0) AS quantity, coalesce(flag, '-') AS flag FROM t")
def fill_constant(spark, d):
    rows = items(spark, d).select("quantity", "flag")
    return columns.fill_constant(columns.fill_constant(rows, 0.0, ["quantity"]), "-", ["flag"])


# ---- cleaning ---------------------------------------------------------------

@query("dedup", f"{T_ITEMS} SELECT DISTINCT line, quantity, discount, flag, status FROM t")
def dedup(spark, d):
    return cleaning.remove_duplicates(items(spark, d).select("line", "quantity", "discount", "flag", "status"))


@query("inf_to_null", f"{T_READ} SELECT event_id, CASE WHEN isnan(reading) OR isinf(reading) THEN NULL ELSE reading END AS reading FROM t")
def inf_to_null(spark, d):
    return cleaning.replace_infinite(readings(spark, d).select("event_id", "reading"))


@query("fill_median", f"""{T_ITEMS} SELECT coalesce(cast(line AS DOUBLE), (SELECT median(line) FROM t)) AS line,
 coalesce(quantity, (SELECT median(quantity) FROM t)) AS quantity, cast(0 AS DOUBLE) AS nothing FROM t""")
def fill_median(spark, d):
    return cleaning.fill_numeric(items(spark, d).select("line", "quantity", "nothing"))


MODE_SQL = "(SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("fill_mode", f"""{T_MESSY} SELECT coalesce(priority, {MODE_SQL.format(c="priority")}) AS priority, 'Unknown' AS empty_text FROM t""")
def fill_mode(spark, d):
    return cleaning.fill_categorical(messy_orders(spark, d).select("priority", "empty_text"))


@query("map_values", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS level
 FROM orders""")
def map_values(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", cleaning.map_values("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}).alias("level"))


@query("lookup_join", """SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_join(spark, d):
    return joins.lookup(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey",
                        table(spark, d, "nation"), "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


TARGET_SQL = "CASE lower(trim(target)) WHEN 'yes' THEN 1 WHEN 'not placed' THEN 0 END"


@query("clean_target", f"{T_MESSY} SELECT {TARGET_SQL} AS target, priority FROM t WHERE {TARGET_SQL} IS NOT NULL")
def clean_target(spark, d):
    return cleaning.clean_binary_target(messy_orders(spark, d).select("target", "priority"), "target")


@query("recode_two_values", """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 3.0 ELSE 8.0 END AS v FROM orders)
 SELECT o_orderkey, CASE WHEN v = (SELECT min(v) FROM t) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS v FROM t""")
def recode_two_values(spark, d):
    rows = table(spark, d, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderstatus = 'F' THEN 3.0D ELSE 8.0D END AS v")
    return cleaning.recode_two_values(rows, "v")


CLEAN_A = f"""{T_MESSY}, u AS (SELECT DISTINCT target, priority, band, step FROM t),
 y AS (SELECT {TARGET_SQL} AS target, priority, band, step FROM u WHERE {TARGET_SQL} IS NOT NULL),
 f AS (SELECT target, coalesce(priority, {MODE_SQL.format(c="priority").replace("FROM t", "FROM y")}) AS priority,
  coalesce(band, (SELECT median(band) FROM y)) AS band, step FROM y),
 g AS (SELECT target, priority, band, CASE WHEN isinf(step) THEN NULL ELSE step END AS step FROM f)
 SELECT target, priority, band, coalesce(step, (SELECT median(step) FROM g)) AS step FROM g"""


@query("clean_pipeline", CLEAN_A)
def clean_pipeline(spark, d):
    return cleaning.clean_data(messy_orders(spark, d), "target")


@query("clean_pipeline_infinite_first", f"""{T_MESSY},
 g AS (SELECT target, priority, band, CASE WHEN isinf(step) THEN NULL ELSE step END AS step FROM t),
 y AS (SELECT DISTINCT {TARGET_SQL} AS target, priority, band, step FROM g WHERE {TARGET_SQL} IS NOT NULL)
 SELECT target, coalesce(priority, {MODE_SQL.format(c="priority").replace("FROM t", "FROM y")}) AS priority,
  coalesce(band, (SELECT median(band) FROM y)) AS band, coalesce(step, (SELECT median(step) FROM y)) AS step FROM y""")
def clean_pipeline_infinite_first(spark, d):
    return cleaning.clean_data(messy_orders(spark, d), "target", infinite_first=True)


@query("cleaning_report", f"""WITH b AS ({CLEAN_A.replace("WITH", "WITH", 1)}), {cte("t", MESSY_ORDERS, "orders")},
 s AS (SELECT count(*) AS rows_before, cast(5 * count(*) - count(target) - count(priority) - count(band) - count(step) - count(empty_text) AS BIGINT) AS missing_before FROM t),
 u AS (SELECT count(*) AS kept FROM (SELECT DISTINCT * FROM t))
 SELECT rows_before, (SELECT count(*) FROM b) AS rows_after, 5 AS columns_before, 4 AS columns_after,
  rows_before - kept AS duplicates_removed, missing_before, cast(0 AS BIGINT) AS missing_after,
  target AS target_value, count(*) AS target_rows FROM b, s, u GROUP BY ALL""")
def cleaning_report(spark, d):
    raw = messy_orders(spark, d)
    return cleaning.cleaning_report(raw, cleaning.clean_data(raw, "target"), "target")


# ---- features ---------------------------------------------------------------

MARKS = ["l_orderkey", "l_linenumber", "nullif(l_quantity, 13.0) AS mark_a", "l_discount * 100 AS mark_b",
         "nullif(l_tax, 0.04) * 100 AS mark_c", "l_extendedprice AS price"]
T_MARKS = "WITH " + cte("t", MARKS, "lineitem")
LIST = "list_filter([mark_a, mark_b, mark_c], lambda x: x IS NOT NULL)"
MEAN3 = f"list_avg({LIST})"
STD3 = f"coalesce(list_stddev_samp({LIST}), 0)"


def marks(spark, d):
    return table(spark, d, "lineitem").selectExpr(*[m.replace("13.0", "13.0D").replace("0.04", "0.04D") for m in MARKS])


@query("row_stats", f"""{T_MARKS} SELECT l_orderkey, l_linenumber, round({MEAN3}, 6) AS mean, round(list_stddev_samp({LIST}), 6) AS std,
 round(list_sum({LIST}), 6) AS total, cast(len({LIST}) AS INTEGER) AS n FROM t""")
def row_stats(spark, d):
    cols = ["mark_a", "mark_b", "mark_c"]
    return rounded(marks(spark, d).select("l_orderkey", "l_linenumber", row_mean(cols).alias("mean"), row_std(cols).alias("std"),
                                          row_sum(cols).alias("total"), row_count(cols).alias("n")))


@query("add_row_mean", f"{T_MARKS} SELECT l_orderkey, l_linenumber, round({MEAN3}, 6) AS average FROM t")
def add_row_mean(spark, d):
    return rounded(features.add_row_mean(marks(spark, d), "mark_", "average").select("l_orderkey", "l_linenumber", "average"))


@query("add_consistency", f"{T_MARKS} SELECT l_orderkey, l_linenumber, round({STD3}, 6) AS consistency FROM t")
def add_consistency(spark, d):
    return rounded(features.add_consistency(marks(spark, d), "mark_", "consistency").select("l_orderkey", "l_linenumber", "consistency"))


SCALED = "(({c} - (SELECT min({c}) FROM t)) / ((SELECT max({c}) FROM t) - (SELECT min({c}) FROM t)) * 100)"
MINMAX = "list_avg(list_filter([" + ", ".join(SCALED.format(c=c) for c in ("mark_a", "mark_b", "price")) + "], lambda x: x IS NOT NULL))"


@query("minmax_score", f"{T_MARKS} SELECT l_orderkey, l_linenumber, round({MINMAX}, 6) AS score FROM t")
def minmax_score(spark, d):
    return rounded(features.add_minmax_score(marks(spark, d), ["mark_a", "mark_b", "price", "absent"], "score")
                   .select("l_orderkey", "l_linenumber", "score"))


WEIGHTED = "coalesce(mark_a, 0) * 0.7 + coalesce(mark_b, 0) * 0.2 + coalesce(mark_c, 0) * 0.1"


@query("weighted_score", f"{T_MARKS} SELECT l_orderkey, l_linenumber, round({WEIGHTED}, 6) AS score FROM t")
def weighted_score(spark, d):
    return rounded(features.add_weighted_score(marks(spark, d), {"mark_a": 0.7, "mark_b": 0.2, "mark_c": 0.1, "absent": 9.0}, "score")
                   .select("l_orderkey", "l_linenumber", "score"))


SUMMED = "coalesce(mark_a, 0) + coalesce(mark_b, 0) + coalesce(mark_c, 0)"


@query("sum_score", f"{T_MARKS} SELECT l_orderkey, l_linenumber, round({SUMMED}, 6) AS score FROM t")
def sum_score(spark, d):
    return rounded(features.add_sum_score(marks(spark, d), ["mark_a", "mark_b", "mark_c"], "score").select("l_orderkey", "l_linenumber", "score"))


@query("engineer_pipeline", f"""{T_MARKS} SELECT l_orderkey, l_linenumber, round(coalesce({MEAN3}, 0), 6) AS average,
 round({STD3}, 6) AS consistency, round(coalesce({MINMAX}, 0), 6) AS level, round({WEIGHTED}, 6) AS skill, round({SUMMED}, 6) AS total FROM t""")
def engineer_pipeline(spark, d):
    made = features.engineer_features(
        marks(spark, d), "mark_", "average", "consistency", {"level": ["mark_a", "mark_b", "price"]},
        {"skill": {"mark_a": 0.7, "mark_b": 0.2, "mark_c": 0.1}}, {"total": ["mark_a", "mark_b", "mark_c"]})
    return rounded(made.select("l_orderkey", "l_linenumber", "average", "consistency", "level", "skill", "total"))


@query("segment_scores", """WITH o AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean_price, sum(o_totalprice) AS total_price
  FROM orders GROUP BY 1),
 t AS (SELECT c_custkey, c_mktsegment, coalesce(c_acctbal, 0) AS balance, n AS orders, mean_price, total_price
  FROM customer LEFT JOIN o ON c_custkey = o_custkey),
 f AS (SELECT c_custkey, c_mktsegment, balance, coalesce(cast(orders AS DOUBLE), (SELECT median(orders) FROM t)) AS orders,
  coalesce(mean_price, (SELECT median(mean_price) FROM t)) AS mean_price,
  coalesce(total_price, (SELECT median(total_price) FROM t)) AS total_price FROM t),
 s AS (SELECT c_mktsegment,
  ((orders - (SELECT min(orders) FROM f)) / ((SELECT max(orders) FROM f) - (SELECT min(orders) FROM f)) * 100
   + (mean_price - (SELECT min(mean_price) FROM f)) / ((SELECT max(mean_price) FROM f) - (SELECT min(mean_price) FROM f)) * 100
   + (total_price - (SELECT min(total_price) FROM f)) / ((SELECT max(total_price) FROM f) - (SELECT min(total_price) FROM f)) * 100) / 3 AS activity,
  0.6 * orders + 0.0001 * balance AS worth FROM f)
 SELECT c_mktsegment, round(avg(activity), 6) AS mean_activity, round(avg(worth), 6) AS mean_worth FROM s GROUP BY 1""")
def segment_scores(spark, d):
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    history = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.avg("o_totalprice").alias("mean_price"), F.sum("o_totalprice").alias("total_price"))
    rows = customer.select("c_custkey", "c_mktsegment", F.col("c_acctbal").alias("balance")).join(history, "c_custkey", "left")
    clean = cleaning.fill_numeric(cleaning.replace_infinite(rows), ["orders", "mean_price", "total_price"])
    filled = columns.fill_constant(clean, 0.0, ["balance"])
    scores = features.add_weighted_score(
        features.add_minmax_score(filled, ["orders", "mean_price", "total_price"], "activity"),
        {"orders": 0.6, "balance": 0.0001}, "worth")
    return rounded(statistics.group_mean(scores, ["c_mktsegment"], ["activity", "worth"]))


# ---- texts ------------------------------------------------------------------

@query("slugify", """SELECT p_partkey, trim(regexp_replace(lower(p_name || ' (' || p_brand || ') ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
 replace(replace(replace(lower(p_name || '+' || p_brand), ' ', '_'), '-', '_'), '+', 'plus') AS safe,
 lower(trim('  ' || p_type || ' ')) AS plain, regexp_replace('numeric__' || p_brand, '^(numeric__|categorical__)', '') AS stripped FROM part""")
def slugify(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", slug(F.concat_ws("", "p_name", F.lit(" ("), "p_brand", F.lit(") "), "p_type")).alias("slug"),
        safe_name(F.concat_ws("+", "p_name", "p_brand")).alias("safe"),
        strip_lower(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("plain"),
        strip_prefix(F.concat(F.lit("numeric__"), "p_brand"), ["numeric__", "categorical__"]).alias("stripped"))


@query("format_cells", f"""{T_READ} SELECT event_id, CASE WHEN reading IS NULL OR isnan(reading) OR isinf(reading) THEN '—' ELSE printf('%.4f', reading) END AS cell,
 coalesce(kind, '—') AS kind_cell, format('{{:,}}', event_id * 1000) AS thousands FROM t""")
def format_cells(spark, d):
    rows = cleaning.replace_infinite(readings(spark, d))
    return rows.select("event_id", format_cell("reading").alias("cell"), format_cell("kind", False).alias("kind_cell"),
                       format_count(F.col("event_id") * 1000).alias("thousands"))


# ---- preparation ------------------------------------------------------------

@query("zscore", """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
 cast(0 AS DOUBLE) AS constant FROM customer""")
def zscore(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.lit(7.0).alias("constant"))
    return rounded(prep.scale_columns(rows, ["c_acctbal", "constant"]))


@query("impute_scale", f"""{T_ITEMS}, f AS (SELECT coalesce(cast(line AS DOUBLE), (SELECT median(line) FROM t)) AS line,
  coalesce(quantity, (SELECT median(quantity) FROM t)) AS quantity FROM t)
 SELECT round((line - avg(line) OVER ()) / stddev_pop(line) OVER (), 6) AS line,
  round((quantity - avg(quantity) OVER ()) / stddev_pop(quantity) OVER (), 6) AS quantity FROM f""")
def impute_scale(spark, d):
    rows = items(spark, d).select("line", "quantity")
    filled = prep.MedianImputer(inputCols=["line", "quantity"]).fit(rows).transform(rows)
    return rounded(prep.PopulationScaler(inputCols=["line", "quantity"]).fit(filled).transform(filled))


@query("mode_impute", f"{T_MESSY} SELECT coalesce(priority, {MODE_SQL.format(c='priority')}) AS priority FROM t")
def mode_impute(spark, d):
    rows = messy_orders(spark, d).select("priority")
    return prep.ModeImputer(inputCols=["priority"]).fit(rows).transform(rows)


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s}"
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer")
def one_hot(spark, d):
    return prep.one_hot_columns(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"]).drop("c_mktsegment")


@query("prepare_numeric", """WITH r AS (SELECT event_id, CASE WHEN value > 30 THEN NULL ELSE value END AS reading, cast(user_id AS DOUBLE) AS u FROM events),
 f AS (SELECT event_id, coalesce(reading, (SELECT median(reading) FROM r)) AS reading, u FROM r)
 SELECT event_id, round((u - avg(u) OVER ()) / stddev_pop(u) OVER (), 6) AS user_id,
  round((reading - avg(reading) OVER ()) / stddev_pop(reading) OVER (), 6) AS reading FROM f""")
def prepare_numeric(spark, d):
    rows = readings(spark, d).withColumn("nothing", F.lit(None).cast("double")).withColumn("target", F.lit(1))
    return rounded(prep.prepare_numeric(rows, ["target"], ["event_id"])[0])
