"""Read, clean, engineer, profile and encode a table in one chain."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_data, cleaning_report
from ..operators.columns import feature_diff, require_columns
from ..operators.prep import feature_names, fit_preprocessor, transform_data
from ..operators.statistics import run_profile
from ..runtime import reused
from ..sources.tables import read_table, save_model, write_csv, write_matrix


def run_preprocessing(df: DataFrame, ids: Sequence[str], features: Sequence[str],
                      folder: str | None = None) -> tuple[DataFrame, PipelineModel]:
    """Fit the preprocessor and encode the table; with a folder also store matrix, names and model."""
    require_columns(df, [*ids, *features])
    model = fit_preprocessor(df, features)
    encoded = transform_data(model, df, features)
    if folder:
        write_matrix(encoded, ids[0], "features", f"{folder}/matrix")
        write_csv(feature_names(encoded), f"{folder}/feature_names", single_file=True)
        save_model(model, f"{folder}/preprocessor")
    return encoded, model


def run_prepare(spark: SparkSession, path: str, folder: str, ids: Sequence[str], features: Sequence[str],
                target: str | None = None, engineer: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The whole preparation of a stored table; writes every result under ``folder``, returns a summary row."""
    raw = read_table(spark, path)
    with reused(clean_data(raw, target, infinite_first=True)) as clean:
        ready = engineer(clean) if engineer else clean
        ready.write.mode("overwrite").parquet(f"{folder}/engineered")
        stored = spark.read.parquet(f"{folder}/engineered")  # reports read the result, not its history
        for name, table in run_profile(stored, target).items():
            write_csv(table, f"{folder}/{name}", single_file=True)
        write_csv(cleaning_report(raw, clean, target), f"{folder}/cleaning_report", single_file=True)
        diff = feature_diff(clean, ready)
    encoded, _ = run_preprocessing(stored, ids, features, folder)
    rows = encoded.agg(F.count("*").alias("rows"))
    width = encoded.schema["features"].metadata.get("ml_attr", {}).get("num_attrs", len(features))
    summary = rows.select("rows", F.lit(len(features)).alias("inputs"), F.lit(width).alias("encoded_features"),
                          F.lit(diff.first()["new_columns"]).alias("new_columns"))
    write_csv(summary, f"{folder}/summary", single_file=True)
    return summary
