"""``pyspark.ml`` stages for the feature pipeline.

Every stage is a Transformer (or Estimator/Model pair) with typed Params and
``DefaultParamsReadable``/``DefaultParamsWritable`` so whole pipelines save
and load. Each ``_transform`` only adds DataFrame operations to the plan; the
only action is the one-row average in ``MeanImputer._fit``.
"""

from __future__ import annotations

import logging
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

log = logging.getLogger(__name__)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Shared keyword-only ``setParams``."""

    @keyword_only
    def setParams(self, **kwargs):
        return self._set(**self._input_kwargs)


class DailySum(Transformer, HasInputCol, HasOutputCol, _Stage):
    """Grouped sum: ``groupBy(groupCols).agg(sum(inputCol) AS outputCol)``.

    Planned as a partial (map-side) hash aggregate, one shuffle on the group
    keys and a final aggregate, so a hot key is combined before it moves.
    Null keys form their own group.
    """

    groupCols = Param(Params._dummy(), "groupCols", "group key columns",
                      typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, groupCols=None):
        super().__init__()
        self._setDefault(groupCols=[])
        self._set(**self._input_kwargs)

    def getGroupCols(self) -> list[str]:
        return self.getOrDefault(self.groupCols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.getGroupCols()).agg(
            F.sum(self.getInputCol()).alias(self.getOutputCol()))


class ZeroReplacer(Transformer, HasInputCols, _Stage):
    """Replace exact zeros by ``value`` in the listed columns only, so a
    later log is defined. Integer columns keep their type (and so their
    zeros), as ``DataFrame.replace`` casts the replacement to the column
    type."""

    value = Param(Params._dummy(), "value", "replacement for 0",
                  typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, value=0.5):
        super().__init__()
        self._setDefault(value=0.5)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.replace(0.0, self.getOrDefault(self.value), subset=self.getInputCols())


class LogTransformer(Transformer, HasInputCol, HasOutputCol, _Stage):
    """Natural log; x <= 0 and null give null."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), F.ln(F.col(self.getInputCol())))


class LagFeatures(Transformer, HasInputCol, HasOutputCol, _Stage):
    """Columns ``{outputCol}1..{outputCol}N`` = value 1..N rows earlier in the
    same series, ordered by ``timeCol``.

    Lags count rows, not calendar days, and never cross series. All N lags
    share one window spec and are added by a single ``withColumns``, which
    plans as one shuffle on the series key, one sort and one Window node.
    """

    numLags = Param(Params._dummy(), "numLags", "number of lags",
                    typeConverter=TypeConverters.toInt)
    timeCol = Param(Params._dummy(), "timeCol", "ordering column",
                    typeConverter=TypeConverters.toString)
    partitionCols = Param(Params._dummy(), "partitionCols", "series key columns",
                          typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, numLags=12, timeCol=None, partitionCols=None):
        super().__init__()
        self._setDefault(numLags=12, partitionCols=[])
        self._set(**self._input_kwargs)

    def lagColumns(self) -> list[str]:
        return [f"{self.getOutputCol()}{i}" for i in range(1, self.getOrDefault(self.numLags) + 1)]

    def _transform(self, df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*self.getOrDefault(self.partitionCols)).orderBy(
            self.getOrDefault(self.timeCol))
        src = F.col(self.getInputCol())
        return df.withColumns(
            {name: F.lag(src, i).over(w) for i, name in enumerate(self.lagColumns(), start=1)})


class MeanImputer(Estimator, HasInputCols, _Stage):
    """Fill nulls (and NaN) with the column average learnt in ``fit``.

    Fit on the training rows to keep test rows out of the fill values; fit
    on all rows to reproduce fill-before-split. Columns are cast to double
    before filling so an integer column is not truncated. A column with no
    value at all has no average: it is left null and reported.
    """

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MeanImputerModel:
        cols = self.getInputCols()
        row = df.agg(*[F.avg(_present(df, c)).alias(c) for c in cols]).first()
        means = [float("nan") if row[c] is None else float(row[c]) for c in cols]
        missing = [c for c, m in zip(cols, means) if math.isnan(m)]
        if missing:
            log.warning("MeanImputer: no values to average in %s; left null", missing)
        model = MeanImputerModel(inputCols=cols, fillValues=means)
        return self._copyValues(model)


class MeanImputerModel(Model, HasInputCols, _Stage):
    fillValues = Param(Params._dummy(), "fillValues", "per-column fill values (NaN = none)",
                       typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, fillValues=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def unfilledColumns(self) -> list[str]:
        return [c for c, v in zip(self.getInputCols(), self.getOrDefault(self.fillValues))
                if math.isnan(v)]

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, v in zip(self.getInputCols(), self.getOrDefault(self.fillValues)):
            present = _present(df, c)
            out[c] = present if math.isnan(v) else F.coalesce(present, F.lit(v))
        return df.withColumns(out)


def _present(df: DataFrame, c: str):
    """Column as double with NaN mapped to null."""
    x = F.col(c).cast("double")
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        x = F.when(~F.isnan(x), x)
    return x


def _missing(df: DataFrame, c: str):
    """Type-aware missing test: NaN only exists for float/double."""
    dtype = df.schema[c].dataType
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: per column, how many values are null (or NaN)."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(*[F.count_if(_missing(df, c)).cast("long").alias(c) for c in cols])


class NullProfiler(Transformer, _Stage):
    """Pipeline form of :func:`null_profile` over all columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return null_profile(df)
