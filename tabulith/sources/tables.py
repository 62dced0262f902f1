"""Reading and writing tables, reports and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import as_column
from ..operators.columns import require_columns
from ..operators.ordering import hash_key


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               required: Sequence[str] = ()) -> DataFrame:
    """A Parquet file or folder, or CSV with a header; raises if absent or if a required column is.

    Give a schema for big CSV inputs: inferring one reads the data twice.
    """
    if path.rstrip("/").endswith(".parquet"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return require_columns(reader.parquet(path), required)
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return require_columns(reader.csv(path), required)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Names of matching files on any file system Spark reads; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return sorted(r["path"] for r in files.collect())


def resolve_source(spark: SparkSession, folder: str, preferred: Sequence[str] = ()) -> str:
    """The first preferred file that exists in the folder, else its first CSV file."""
    found = list_files(spark, folder)
    by_name = {p.rsplit("/", 1)[-1]: p for p in found}
    for name in preferred:
        if name in by_name:
            return by_name[name]
    if not found:
        raise FileNotFoundError(f"no CSV file in {folder}")
    return found[0]


def report_values(report: DataFrame, key: str, name: str, metrics: Sequence[str]) -> DataFrame:
    """One algorithm's row of a result table as (metric, value), empty values left out."""
    present = [m for m in metrics if m in report.columns]
    row = report.where(F.trim(as_column(key).cast("string")) == name).limit(1)
    texts = row.select(*[as_column(m).cast("string").alias(m) for m in present])
    return texts.unpivot([], present, "metric", "value").where(F.col("value").isNotNull())


def read_report(spark: SparkSession, path: str, key: str, name: str, metrics: Sequence[str]) -> DataFrame:
    return report_values(read_table(spark, path), key, name, metrics)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for report-sized tables only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def as_json(df: DataFrame, out: str = "json") -> DataFrame:
    """Every row as one JSON document."""
    return df.select(F.to_json(F.struct(*[as_column(c) for c in df.columns])).alias(out))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_matrix(df: DataFrame, key: str, vector: str, path: str) -> None:
    """Ids and feature vectors as plain arrays, in Parquet."""
    (df.select(as_column(key), vector_to_array(vector).alias("values")).write.mode("overwrite").parquet(path))


def write_embedding(points: DataFrame, labels: DataFrame, key: str, label: str, path: str) -> None:
    """Coordinates with the cluster of the same id, as CSV."""
    write_csv(points.join(labels.select(as_column(key), as_column(label)), key, "left"), path)


def report_tables(spark: SparkSession, folder: str, rows: int = 100) -> dict[str, DataFrame]:
    """Every stored CSV of a folder by name, at most ``rows`` sampled rows each."""
    tables = {}
    for path in list_files(spark, folder):
        table = read_table(spark, path)
        tables[path.rsplit("/", 1)[-1]] = table.orderBy(hash_key(table.columns, 7)).limit(rows)
    return tables
