"""Session-level helpers: lineage cuts that survive lost executors, one-row statistics."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, below it one folder per application.

    Only a local session may leave the setting out; its warehouse takes the place. What
    an application stored there is removed when its session ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    folder = f"{base.rstrip('/')}/tabulith-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back (runs a job)."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give the session a checkpoint folder if it has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def write_out(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and read it back (runs a job).

    For tables that several later passes read a few columns of.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_state(df: DataFrame, name: str, before: str | None) -> tuple[DataFrame, str]:
    """``write_out`` for the state of a loop: (frame, folder); the folder ``before`` is removed once the new state is stored.

    A checkpoint keeps the size that Spark guessed for its plan, and a join guesses the product of its sides: in a loop
    of joins that number gains digits so fast that planning takes longer every round. Stored files have their own size.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    if before is not None:
        old = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
        old.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def reused(df: DataFrame):
    """Keep ``df`` in memory/disk for the length of the block; lost blocks are recomputed."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def one_row(stats: DataFrame, *names: str) -> Column:
    """Turn a one-row aggregate into a struct expression usable in any other query.

    Compiles to a scalar subquery, so it costs one aggregate and no join.
    """
    picked = names or stats.columns
    return stats.select(F.struct(*[F.col(f"`{n}`") for n in picked]).alias("row")).scalar()


def rows_as_struct(long: DataFrame, key: str, value: str, names: list[str]) -> Column:
    """One struct field per name out of a (key, value) table that has one row per name."""
    wide = long.agg(*[F.max(F.when(F.col(key) == n, F.col(value))).alias(n) for n in names])
    return one_row(wide)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A result-sized DataFrame (parameters, one metric row per model)."""
    return spark.createDataFrame(rows, schema)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written results, below the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
