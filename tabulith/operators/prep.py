"""Fit/transform preprocessing as Spark ML stages, so that it composes with any ML pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column, z_score
from ..runtime import one_row, small_frame
from .cleaning import column_medians, column_modes, fill_numeric, replace_infinite
from .columns import categorical_columns, missing, numeric_columns, remove_empty_columns, require_columns

MAX_LEVELS = 100_000  # distinct texts of one column that may be listed on the driver


class _Columns(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    pass


class ColumnFill(Model, _Columns):
    """Replace missing cells by one stored value per column."""

    numbers = Param(Params._dummy(), "numbers", "fill values of numeric columns", TypeConverters.toListFloat)
    texts = Param(Params._dummy(), "texts", "fill values of text columns", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = require_columns(df, self.getInputCols()) and self.getInputCols()
        if self.isDefined(self.numbers):
            return df.withColumns({
                c: F.coalesce(F.when(~missing(df, c), as_column(c).cast("double")), F.lit(v))
                for c, v in zip(cols, self.getOrDefault(self.numbers))})
        return df.withColumns({c: F.coalesce(as_column(c).cast("string"), F.lit(v))
                               for c, v in zip(cols, self.getOrDefault(self.texts))})


class MedianImputer(Estimator, _Columns):
    """Exact median per column; 0 for a column without values."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ColumnFill:
        cols = self.getInputCols()
        found = {r["column"]: r["median"] for r in column_medians(df, cols).collect()}  # one row per column
        model = ColumnFill()
        return model._set(inputCols=cols, numbers=[0.0 if found.get(c) is None else found[c] for c in cols])


class ModeImputer(Estimator, _Columns):
    """Most frequent text per column, the smallest on ties."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ColumnFill:
        cols = self.getInputCols()
        found = {r["column"]: r["mode"] for r in column_modes(df, cols).collect()}  # one row per column
        model = ColumnFill()
        return model._set(inputCols=cols, texts=[found.get(c) or "Unknown" for c in cols])


class ColumnScale(Model, _Columns):
    """(x - mean) / std with stored statistics."""

    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "divisor per column", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = require_columns(df, self.getInputCols()) and self.getInputCols()
        return df.withColumns({c: (as_column(c) - F.lit(m)) / F.lit(s) for c, m, s in
                               zip(cols, self.getOrDefault(self.means), self.getOrDefault(self.stds))})


class PopulationScaler(Estimator, _Columns):
    """Zero mean and unit population deviation; a constant column is only centred."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ColumnScale:
        cols = self.getInputCols()
        row = df.agg(*[F.avg(as_column(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(as_column(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        model = ColumnScale()
        return model._set(inputCols=cols, means=[float(row[f"m{i}"] or 0.0) for i, _ in enumerate(cols)],
                          stds=[float(row[f"s{i}"] or 1.0) for i, _ in enumerate(cols)])


def scale_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lazy form of ``PopulationScaler``: z-scores of whole columns in one query."""
    stats = df.agg(*[F.avg(as_column(c)).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[F.stddev_pop(as_column(c)).alias(f"s{i}") for i, c in enumerate(columns)])
    frame = df.withColumn("_s", one_row(stats))
    return frame.withColumns({c: z_score(as_column(c).cast("double"), F.col(f"_s.m{i}"), F.col(f"_s.s{i}"))
                              for i, c in enumerate(columns)}).drop("_s")


def _check_levels(df: DataFrame, columns: Sequence[str]) -> None:
    row = df.agg(*[F.approx_count_distinct(as_column(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    wide = [c for i, c in enumerate(columns) if row[f"n{i}"] > MAX_LEVELS]
    if wide:
        raise ValueError(f"more than {MAX_LEVELS} levels in {', '.join(wide)}; encode them by a join with a level table")


def one_hot_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One 0/1 column per level, named ``column_level``, levels in alphabetical order (lists the levels)."""
    _check_levels(df, columns)
    encoded = df
    for c in columns:
        levels = [r[0] for r in df.select(as_column(c)).where(as_column(c).isNotNull()).distinct().collect()]
        encoded = encoded.withColumns({f"{c}_{v}": F.when(as_column(c) == F.lit(v), 1).otherwise(0)
                                       for v in sorted(levels)})
    return encoded


def create_preprocessor(numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> Pipeline:
    """Median fill and scaling of numbers, mode fill and one-hot of texts, assembled into one vector.

    The output also keeps the input columns: numbers scaled, texts filled.
    """
    if not numeric and not categorical:
        raise ValueError("no feature columns")
    stages, parts = [], []
    if numeric:
        stages += [MedianImputer(inputCols=list(numeric)), PopulationScaler(inputCols=list(numeric))]
        parts += list(numeric)
    if categorical:
        index, hot = [f"{c}__index" for c in categorical], [f"{c}__hot" for c in categorical]
        stages += [ModeImputer(inputCols=list(categorical)),
                   StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   # "keep" adds one slot for unseen texts; dropping that last slot leaves them all zero
                   OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True)]
        parts += hot
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol=out)])


def fit_preprocessor(df: DataFrame, features: Sequence[str], out: str = "features") -> PipelineModel:
    require_columns(df, features)
    texts = categorical_columns(df, features)
    if texts:
        _check_levels(df, texts)
    numbers = numeric_columns(df, features)
    return create_preprocessor([c for c in features if c in numbers], [c for c in features if c in texts], out).fit(df)


def transform_data(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Apply a fitted preprocessor; a missing input column is an error."""
    return model.transform(require_columns(df, features))


def feature_names(df: DataFrame, column: str = "features") -> DataFrame:
    """(index, name) of every slot of a vector column, from its metadata; ``Feature_i`` without metadata."""
    return small_frame(df.sparkSession, list(enumerate(slot_names(df, column))), "index int, name string")


def slot_names(df: DataFrame, column: str = "features", width: int | None = None) -> list[str]:
    meta = df.schema[column].metadata.get("ml_attr", {})
    slots = {a["idx"]: a.get("name") for group in meta.get("attrs", {}).values() for a in group}
    size = meta.get("num_attrs") or width or (max(slots) + 1 if slots else 0)
    return [(slots.get(i) or f"Feature_{i}").replace("__hot_", "_") for i in range(size)]


def prepare_numeric(df: DataFrame, targets: Sequence[str] = (), ids: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Numeric columns without the targets: infinities and gaps filled by the median, then z-scored.

    Returns the frame (ids first) and the feature names. Runs the aggregate of ``remove_empty_columns``.
    """
    numbers = [c for c in numeric_columns(df) if c not in targets and c not in ids]
    data = df.select(*[as_column(c) for c in ids], *[as_column(c).cast("double").alias(c) for c in numbers])
    data = replace_infinite(data, numbers)
    present = remove_empty_columns(data.select(*[as_column(c) for c in numbers])).columns
    data = fill_numeric(data.select(*[as_column(c) for c in [*ids, *present]]), present)
    return scale_columns(data, present), present
