"""Inputs used by several queries. The select lists are valid in Spark SQL and in DuckDB alike.

The given tables are clean, so gaps, infinities, copies and messy texts are made here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import table

# lineitem with gaps; no key, so rows repeat
ITEMS = [
    "nullif(l_linenumber, 3) AS line", "nullif(l_quantity, 13.0) AS quantity", "l_discount AS discount",
    "l_tax AS tax", "nullif(l_returnflag, 'A') AS flag", "l_linestatus AS status",
    "cast(NULL AS DOUBLE) AS nothing", "cast(7 AS DOUBLE) AS constant",
]
# events with infinities, NaN and a text gap
READINGS = [
    "event_id", "user_id", "nullif(event_type, 'click') AS kind",
    "CASE WHEN value > 60 THEN cast('Infinity' AS DOUBLE) WHEN value > 40 THEN cast('-Infinity' AS DOUBLE) "
    "WHEN value > 30 THEN cast('NaN' AS DOUBLE) ELSE value END AS reading",
]
# orders with a messy yes/no target, a repeating shape and gaps
MESSY_ORDERS = [
    "CASE o_orderstatus WHEN 'F' THEN ' Yes ' WHEN 'O' THEN 'Not Placed' ELSE 'unknown' END AS target",
    "nullif(o_orderpriority, '5-LOW') AS priority",
    "CASE WHEN o_totalprice > 400000 THEN NULL ELSE floor(o_totalprice / 20000) END AS band",
    "CASE WHEN o_totalprice < 30000 THEN cast('Infinity' AS DOUBLE) ELSE floor(o_totalprice / 50000) END AS step",
    "cast(NULL AS VARCHAR(10)) AS empty_text",
]
# a fixed score that grows with the text length, for the metrics
SCORED = """SELECT l.doc_id AS id, l.quality AS y, round(d.n_chars::DOUBLE / (d.n_chars + 2000), 6) AS score,
 CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS guess,
 d.n_chars, d.lang, d.source
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def cte(name: str, select: Sequence[str], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(select)} FROM {source})"


def items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr(*[s.replace("VARCHAR(10)", "STRING") for s in ITEMS])


def readings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(*READINGS)


def messy_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(*[s.replace("VARCHAR(10)", "STRING") for s in MESSY_ORDERS])


def scored(spark: SparkSession, d: str) -> DataFrame:
    labels, docs = table(spark, d, "labels"), table(spark, d, "documents")
    joined = labels.join(docs.select("doc_id", "n_chars", "lang", "source"), "doc_id")
    score = "round(cast(n_chars AS DOUBLE) / (n_chars + 2000), 6)"
    return joined.selectExpr("doc_id AS id", "quality AS y", f"{score} AS score",
                             "CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END AS guess", "n_chars", "lang", "source")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that the order of summation does not show."""
    from pyspark.sql import functions as F
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])
