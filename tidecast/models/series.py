"""Per-series forecasters. A fitted model is a table of coefficients per
series; scoring joins that table to the rows to forecast and evaluates the
formula in Spark expressions, so any future dates can be scored without
Python.

* :class:`TrendWeekdayForecaster` - linear trend by ``regr_slope`` /
  ``regr_intercept`` plus the mean residual per weekday. Pure aggregates.
* :class:`FourierForecaster` - additive linear trend + yearly (order 10) and
  weekly (order 3) Fourier terms, after Taylor & Letham, "Forecasting at
  Scale" (2018), fitted by ridge least squares. Rows are shuffled by series
  and stretch of days and sorted, so that numpy reduces each stretch to one
  system (X'X, X'y) instead of one for each input batch; only these systems
  reach the grouped pandas function (``applyInPandas``) that adds and solves
  them. A within-day term is constant on daily data and is left out. Series
  shorter than a year have no yearly terms, those shorter than two weeks no
  weekly ones.

``fit`` writes the coefficient tables, so scoring never fits again. A null in
a series key is a key like any other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tidecast.operators.joins import null_safe_join
from tidecast.session import materialize


class _SeriesParams(HasLabelCol, HasPredictionCol):
    groupCols = Param(Params._dummy(), "groupCols", "series key columns",
                      typeConverter=TypeConverters.toListString)
    timeCol = Param(Params._dummy(), "timeCol", "integer day column",
                    typeConverter=TypeConverters.toString)
    dateCol = Param(Params._dummy(), "dateCol", "date column (weekday, cutoff)",
                    typeConverter=TypeConverters.toString)
    cutoff = Param(Params._dummy(), "cutoff",
                   "fit only on rows with date <= cutoff (ISO date); empty = all rows",
                   typeConverter=TypeConverters.toString)

    def _series_defaults(self):
        self._setDefault(labelCol="LogSales", predictionCol="yhat", groupCols=[],
                         timeCol="day", dateCol="date", cutoff="")

    def _keys(self) -> list[str]:
        keys = self.getOrDefault(self.groupCols)
        if not keys:
            raise ValueError("groupCols names the series; it must not be empty")
        return keys

    def _training_rows(self, df: DataFrame) -> DataFrame:
        cutoff = self.getOrDefault(self.cutoff)
        rows = df.where(F.col(self.getLabelCol()).isNotNull())
        if cutoff:
            rows = rows.where(F.col(self.getOrDefault(self.dateCol)) <= F.lit(cutoff).cast("date"))
        return rows


class TrendWeekdayForecaster(Estimator, _SeriesParams):
    @keyword_only
    def __init__(self, labelCol="LogSales", predictionCol="yhat", groupCols=None,
                 timeCol="day", dateCol="date", cutoff=""):
        super().__init__()
        self._series_defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TrendWeekdayModel:
        keys, t, y = self._keys(), self.getOrDefault(self.timeCol), self.getLabelCol()
        dow = F.dayofweek(self.getOrDefault(self.dateCol)).cast("int").alias("_dow")
        train = self._training_rows(df).select(*keys, F.col(t).cast("double").alias("_t"),
                                               F.col(y).alias("_y"), dow)
        trend = materialize(train.groupBy(*keys).agg(
            F.regr_slope("_y", "_t").alias("slope"),
            F.regr_intercept("_y", "_t").alias("intercept"),
        ), "trend")
        residual = F.col("_y") - (F.col("intercept") + F.col("slope") * F.col("_t"))
        weekday = (null_safe_join(train, trend, keys, "inner").groupBy(*keys, "_dow")
                   .agg(F.avg(residual).alias("effect")))
        model = TrendWeekdayModel(trend, materialize(weekday, "weekday"))
        return self._copyValues(model)


class _TablesWriter(MLWriter):
    """Params as metadata, each table of the model as Parquet beside them."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=self.model._extra())
        for name, table in self.model._tables().items():
            table.write.parquet(f"{path}/{name}")


class _TablesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls(*[spark.read.parquet(f"{path}/{name}") for name in self.cls.TABLES],
                         *[meta[name] for name in self.cls.EXTRA])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class _TableModel(Model, _SeriesParams, MLWritable, MLReadable):
    """A model that holds tables: saves and loads alone and in pipelines, and
    overwrites nothing unless asked (``write().overwrite()``)."""

    TABLES: tuple[str, ...] = ()
    EXTRA: tuple[str, ...] = ()

    def _tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.TABLES}

    def _extra(self) -> dict:
        return {name: getattr(self, name) for name in self.EXTRA}

    def write(self) -> MLWriter:
        return _TablesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TablesReader(cls)

    @classmethod
    def load(cls, *at):
        """``load(path)``; a session may stand before the path."""
        return cls.read().load(at[-1])


class TrendWeekdayModel(_TableModel):
    """Coefficient tables: (series, slope, intercept) and (series, weekday,
    effect)."""

    TABLES = ("trend", "weekday")

    def __init__(self, trend: DataFrame | None = None, weekday: DataFrame | None = None):
        super().__init__()
        self._series_defaults()
        self.trend = trend
        self.weekday = weekday

    def _transform(self, df: DataFrame) -> DataFrame:
        keys, t = self._keys(), self.getOrDefault(self.timeCol)
        dow = F.dayofweek(self.getOrDefault(self.dateCol)).cast("int")
        scored = null_safe_join(null_safe_join(df.withColumn("_dow", dow), self.trend, keys),
                                self.weekday, [*keys, "_dow"])
        yhat = (F.col("intercept") + F.col("slope") * F.col(t).cast("double")
                + F.coalesce(F.col("effect"), F.lit(0.0)))
        return scored.withColumn(self.getPredictionCol(), yhat).drop(
            "_dow", "slope", "intercept", "effect")


# Seasonal periods in days and Fourier orders.
YEAR_DAYS = 365.25
WEEK_DAYS = 7.0
YEARLY_ORDER = 10
WEEKLY_ORDER = 3


def fourier_basis(day: Column, origin_day: float) -> list[Column]:
    """[1, trend, yearly sin/cos 1..10, weekly sin/cos 1..3] of a day number.
    The trend is in years from ``origin_day`` to keep the system well scaled."""
    d = day.cast("double")
    terms = [F.lit(1.0), (d - F.lit(origin_day)) / F.lit(YEAR_DAYS)]
    for period, order in ((YEAR_DAYS, YEARLY_ORDER), (WEEK_DAYS, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            angle = d * F.lit(2.0 * math.pi * k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return terms


N_TERMS = 2 + 2 * (YEARLY_ORDER + WEEKLY_ORDER)


def fourier_basis_np(day: np.ndarray, origin_day: float) -> np.ndarray:
    """The same basis as :func:`fourier_basis`, as an (n, N_TERMS) array."""
    d = day.astype(float)
    cols = [np.ones_like(d), (d - origin_day) / YEAR_DAYS]
    for period, order in ((YEAR_DAYS, YEARLY_ORDER), (WEEK_DAYS, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            angle = d * (2.0 * math.pi * k / period)
            cols += [np.sin(angle), np.cos(angle)]
    return np.column_stack(cols)


_UPPER = np.triu_indices(N_TERMS)
_YEARLY = slice(2, 2 + 2 * YEARLY_ORDER)
_WEEKLY = slice(2 + 2 * YEARLY_ORDER, N_TERMS)
#: Days of a series that one task reduces together.
STRETCH_DAYS = 8192


class FourierForecaster(Estimator, _SeriesParams):
    """Fit = two-level aggregation of the normal equations, then a solve.

    1. Training rows are shuffled by series and stretch of ``STRETCH_DAYS``
       days and sorted by series; ``mapInPandas`` reduces them with numpy to
       one partial (n, first and last day, X'X, X'y) per series and Arrow
       batch. The shuffle moves a row's keys, day and value only.
    2. ``groupBy(series).applyInPandas``: the partials of one series are
       summed and the ridge system is solved.
    """

    regParam = Param(Params._dummy(), "regParam", "ridge penalty on seasonal terms",
                     typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, labelCol="LogSales", predictionCol="yhat", groupCols=None,
                 timeCol="day", dateCol="date", cutoff="", regParam=1.0):
        super().__init__()
        self._series_defaults()
        self._setDefault(regParam=1.0)
        self._set(**self._input_kwargs)

    def partials(self, df: DataFrame) -> tuple[DataFrame, float]:
        """(keys, n, first, last, X'X, X'y) of stretches of the training rows,
        to be added up by series, and the origin of the trend."""
        keys, t, y = self._keys(), self.getOrDefault(self.timeCol), self.getLabelCol()
        train = self._training_rows(df).select(*keys, F.col(t).cast("double").alias("_t"),
                                               F.col(y).cast("double").alias("_y"))
        origin = self._origin(train)
        key_fields = [f for f in train.schema.fields if f.name in keys]
        partial_schema = StructType(key_fields + [
            StructField("n", LongType()),
            StructField("first", DoubleType()),
            StructField("last", DoubleType()),
            StructField("xtx", ArrayType(DoubleType())),
            StructField("xty", ArrayType(DoubleType())),
        ])
        by_series = train.repartition(*keys, F.floor(F.col("_t") / STRETCH_DAYS)).sortWithinPartitions(*keys)
        return by_series.mapInPandas(_partial_normal_equations(keys, origin), partial_schema), origin

    def _fit(self, df: DataFrame) -> FourierModel:
        keys = self._keys()
        partials, origin = self.partials(df)
        key_fields = [f for f in partials.schema.fields if f.name in keys]
        out_schema = StructType(key_fields + [
            StructField("n", LongType()),
            StructField("coef", ArrayType(DoubleType())),
        ])
        solve = _ridge_solver(keys, float(self.getOrDefault(self.regParam)))
        coefficients = partials.groupBy(*keys).applyInPandas(solve, out_schema)
        model = FourierModel(materialize(coefficients, "fourier"), origin)
        return self._copyValues(model)

    def _origin(self, train: DataFrame) -> float:
        """Trend origin: the last training day (a one-row aggregate)."""
        last = train.agg(F.max("_t")).first()[0]
        return float(last) if last is not None else 0.0


def _partial_normal_equations(keys: list[str], origin: float):
    def reduce_batches(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = fourier_basis_np(pdf["_t"].to_numpy(), origin)
            yv = pdf["_y"].to_numpy(dtype=float)
            groups = pdf.groupby(keys, sort=False, dropna=False).indices
            rows = []
            for key, idx in groups.items():
                xi, yi = x[idx], yv[idx]
                key = key if isinstance(key, tuple) else (key,)
                days = pdf["_t"].to_numpy()[idx]
                rows.append([*map(_plain, key), len(idx), days.min(), days.max(), (xi.T @ xi)[_UPPER].tolist(), (xi.T @ yi).tolist()])
            yield pd.DataFrame(rows, columns=[*keys, "n", "first", "last", "xtx", "xty"])

    return reduce_batches


def _plain(key):
    """A key for Arrow: null rather than NaN."""
    return None if pd.isna(key) else key


def _ridge_solver(keys: list[str], reg: float):
    penalty = np.zeros(N_TERMS)
    penalty[2:] = reg  # trend and level are not shrunk

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].sum())
        gram = np.zeros((N_TERMS, N_TERMS))
        gram[_UPPER] = np.sum(np.stack(pdf["xtx"].to_numpy()), axis=0)
        gram = gram + np.triu(gram, 1).T
        rhs = np.sum(np.stack(pdf["xty"].to_numpy()), axis=0)
        days = pdf["last"].max() - pdf["first"].min() + 1
        used = np.ones(N_TERMS, bool)
        used[_YEARLY] = days >= YEAR_DAYS
        used[_WEEKLY] = days >= 2 * WEEK_DAYS
        coef = None
        if n >= 2:
            a = gram + np.diag(penalty + 1e-9 * max(1.0, np.trace(gram) / N_TERMS))
            solved = np.zeros(N_TERMS)
            solved[used] = np.linalg.lstsq(a[np.ix_(used, used)], rhs[used], rcond=None)[0]
            coef = solved.tolist()
        first = pdf.iloc[0]
        return pd.DataFrame([[*(_plain(first[k]) for k in keys), n, coef]], columns=[*keys, "n", "coef"])

    return solve


class FourierModel(_TableModel):
    """Coefficient table (series, n, coef array) plus the trend origin."""

    TABLES, EXTRA = ("coefficients",), ("origin_day",)

    def __init__(self, coefficients: DataFrame | None = None, origin_day: float = 0.0):
        super().__init__()
        self._series_defaults()
        self.coefficients = coefficients
        self.origin_day = origin_day

    def _transform(self, df: DataFrame) -> DataFrame:
        keys, t = self._keys(), self.getOrDefault(self.timeCol)
        # An explicit sum of coef[i] * basis_i stays inside codegen (array
        # lambdas would be interpreted row by row).
        basis = fourier_basis(F.col(t), self.origin_day)
        yhat = None
        for i, b in enumerate(basis):
            term = F.get(F.col("coef"), i) * b
            yhat = term if yhat is None else yhat + term
        scored = null_safe_join(df, self.coefficients.select(*keys, "coef"), keys)
        return scored.withColumn(self.getPredictionCol(), yhat).drop("coef")
