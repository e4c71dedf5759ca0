"""Seasonal forecasts with a trend that may bend.

The basis of the Fourier forecaster, with hinges max(0, day - c) at evenly
spread change points c over the first part of the training days, after Taylor
& Letham, "Forecasting at Scale" (2018). Which of them bend is decided by an
absolute penalty: the fit is a coordinate descent on the normal equations, which are summed
in two levels as in :mod:`tidecast.models.series`, so no row is read again in
the descent. The penalty of a hinge is in proportion to its length and to
the spread of the residuals of the unpenalised fit, so it is the same on every
scale of the label; seasonal terms have a ridge.

After the last change point the trend goes on with its last slope.

Defined results: as of the Fourier forecaster; a series that begins after a
change point, or ends before it, has no hinge there; two rows at least.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tidecast.models.series import (N_TERMS, STRETCH_DAYS, WEEK_DAYS, WEEKLY_ORDER, YEAR_DAYS, YEARLY_ORDER, _plain,
                                    _SeriesParams, _TableModel, fourier_basis, fourier_basis_np)
from tidecast.operators.joins import null_safe_join
from tidecast.session import materialize

_YEARLY = np.arange(2, 2 + 2 * YEARLY_ORDER)
_WEEKLY = np.arange(2 + 2 * YEARLY_ORDER, 2 + 2 * (YEARLY_ORDER + WEEKLY_ORDER))
#: The descent ends when no coefficient moves by more than this share of the
#: largest, or after so many rounds.
TOLERANCE, ROUNDS = 1e-7, 5000


def basis_np(day: np.ndarray, origin: float, points: np.ndarray) -> np.ndarray:
    hinges = np.maximum(day[:, None].astype(float) - points[None, :], 0.0) / YEAR_DAYS
    return np.concatenate([fourier_basis_np(day, origin), hinges], axis=1)


def basis(day: Column, origin: float, points: list[float]) -> list[Column]:
    d = day.cast("double")
    return fourier_basis(day, origin) + [F.greatest(d - F.lit(c), F.lit(0.0)) / F.lit(YEAR_DAYS) for c in points]


def descend(gram: np.ndarray, rhs: np.ndarray, l1: np.ndarray, ridge: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Minimum of half c'Gc - r'c + sum l1 |c| + half sum ridge c c over the
    ``used`` coordinates. Those without ``l1`` are solved together in each
    round, the others one by one."""
    a = gram + np.diag(ridge)
    free = np.flatnonzero(used & (l1 == 0))
    bent = np.flatnonzero(used & (l1 > 0) & (np.diag(gram) > 0))
    c = np.zeros(len(rhs))
    solve = np.linalg.pinv(a[np.ix_(free, free)], hermitian=True)
    # The free coordinates eliminated: a smaller system in the hinges alone.
    cross = a[np.ix_(bent, free)]
    inner = a[np.ix_(bent, bent)] - cross @ solve @ cross.T
    side = rhs[bent] - cross @ solve @ rhs[free]
    penalty, x = l1[bent], np.zeros(len(bent))
    for _ in range(ROUNDS):
        moved = 0.0
        for k in range(len(bent)):
            if inner[k, k] <= 1e-12:
                continue
            pull = side[k] - inner[k] @ x + inner[k, k] * x[k]
            new = math.copysign(max(abs(pull) - penalty[k], 0.0), pull) / inner[k, k]
            moved = max(moved, abs(new - x[k]))
            x[k] = new
        if moved <= TOLERANCE * max(1e-12, np.abs(x).max(initial=0.0)):
            break
    c[bent] = x
    c[free] = solve @ (rhs[free] - cross.T @ x)
    return c


class ChangePointForecaster(Estimator, _SeriesParams):
    changePoints = Param(Params._dummy(), "changePoints", "number of change points", typeConverter=TypeConverters.toInt)
    changeRange = Param(Params._dummy(), "changeRange", "part of the training days that has them",
                        typeConverter=TypeConverters.toFloat)
    changePenalty = Param(Params._dummy(), "changePenalty", "strength of the absolute penalty",
                          typeConverter=TypeConverters.toFloat)
    regParam = Param(Params._dummy(), "regParam", "ridge penalty on seasonal terms", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, labelCol="LogSales", predictionCol="yhat", groupCols=None, timeCol="day", dateCol="date",
                 cutoff="", changePoints=25, changeRange=0.8, changePenalty=1.0, regParam=1.0):
        super().__init__()
        self._series_defaults()
        self._setDefault(changePoints=25, changeRange=0.8, changePenalty=1.0, regParam=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ChangePointModel:
        keys, t, y = self._keys(), self.getOrDefault(self.timeCol), self.getLabelCol()
        train = self._training_rows(df).select(*keys, F.col(t).cast("double").alias("_t"),
                                               F.col(y).cast("double").alias("_y"))
        first, last = train.agg(F.min("_t"), F.max("_t")).first()
        k = self.getOrDefault(self.changePoints)
        points: list[float] = []
        if first is not None and k > 0:
            reach = (last - first) * self.getOrDefault(self.changeRange)
            points = sorted({round(first + reach * (i + 1) / k) for i in range(k)} - {round(last), round(first)})
        origin = float(last) if last is not None else 0.0
        key_fields = [f for f in train.schema.fields if f.name in keys]
        partial = StructType(key_fields + [StructField("n", LongType()), StructField("first", DoubleType()),
                                           StructField("last", DoubleType()), StructField("yy", DoubleType()),
                                           StructField("xtx", ArrayType(DoubleType())),
                                           StructField("xty", ArrayType(DoubleType()))])
        by_series = train.repartition(*keys, F.floor(F.col("_t") / STRETCH_DAYS)).sortWithinPartitions(*keys)
        partials = by_series.mapInPandas(_partials(keys, origin, np.array(points)), partial)
        out = StructType(key_fields + [StructField("n", LongType()), StructField("coef", ArrayType(DoubleType()))])
        fit = _solver(keys, np.array(points), self.getOrDefault(self.changePenalty), self.getOrDefault(self.regParam))
        model = ChangePointModel(materialize(partials.groupBy(*keys).applyInPandas(fit, out), "changes"), origin, points)
        return self._copyValues(model)


def _partials(keys: list[str], origin: float, points: np.ndarray):
    upper = np.triu_indices(N_TERMS + len(points))

    def reduce_batches(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            day, value = pdf["_t"].to_numpy(), pdf["_y"].to_numpy(dtype=float)
            x, rows = basis_np(day, origin, points), []
            for key, at in pdf.groupby(keys, sort=False, dropna=False).indices.items():
                xi, yi = x[at], value[at]
                key = key if isinstance(key, tuple) else (key,)
                rows.append([*map(_plain, key), len(at), day[at].min(), day[at].max(), float(yi @ yi),
                             (xi.T @ xi)[upper].tolist(), (xi.T @ yi).tolist()])
            yield pd.DataFrame(rows, columns=[*keys, "n", "first", "last", "yy", "xtx", "xty"])

    return reduce_batches


def fit_series(n: int, first: float, last: float, yy: float, gram: np.ndarray, rhs: np.ndarray, points: np.ndarray,
               penalty: float, reg: float) -> np.ndarray:
    """Coefficients of one series from its normal equations."""
    size, days = len(rhs), last - first + 1
    used = np.ones(size, bool)
    used[_YEARLY] = days >= YEAR_DAYS
    used[_WEEKLY] = days >= 2 * WEEK_DAYS
    used[N_TERMS:] = (points > first) & (points < last)
    ridge = np.full(size, 1e-9 * max(1.0, np.trace(gram) / size))
    ridge[_YEARLY] += reg
    ridge[_WEEKLY] += reg
    loose = descend(gram, rhs, np.zeros(size), ridge, used)
    free = max(n - int(used.sum()), 1)
    spread = math.sqrt(max(yy - 2 * rhs @ loose + loose @ gram @ loose, 0.0) / free)
    l1 = np.zeros(size)
    l1[N_TERMS:] = penalty * spread * math.sqrt(2 * math.log(max(len(points), 2))) * np.sqrt(np.diag(gram)[N_TERMS:])
    # Where hinges are not worth their penalty none bends at all.
    l1[N_TERMS:] = np.maximum(l1[N_TERMS:], 1e-12)
    return descend(gram, rhs, l1, ridge, used)


def _solver(keys: list[str], points: np.ndarray, penalty: float, reg: float):
    size = N_TERMS + len(points)
    upper = np.triu_indices(size)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        gram = np.zeros((size, size))
        gram[upper] = np.sum(np.stack(pdf["xtx"].to_numpy()), axis=0)
        gram = gram + np.triu(gram, 1).T
        rhs, n = np.sum(np.stack(pdf["xty"].to_numpy()), axis=0), int(pdf["n"].sum())
        coef = None
        if n >= 2:
            coef = fit_series(n, pdf["first"].min(), pdf["last"].max(), float(pdf["yy"].sum()), gram, rhs, points,
                              penalty, reg).tolist()
        row = pdf.iloc[0]
        return pd.DataFrame([[*(_plain(row[k]) for k in keys), n, coef]], columns=[*keys, "n", "coef"])

    return solve


class ChangePointModel(_TableModel):
    """(series, n, coef array), the origin of the trend and the change points."""

    TABLES, EXTRA = ("coefficients",), ("origin_day", "points")

    def __init__(self, coefficients: DataFrame | None = None, origin_day: float = 0.0, points: list[float] | None = None):
        super().__init__()
        self._series_defaults()
        self.coefficients, self.origin_day, self.points = coefficients, origin_day, points or []

    def changes(self) -> DataFrame:
        """(series, day, change): the days at which the slope of a series
        changes, and by how much a year."""
        keys = self._keys()
        bends = F.slice("coef", N_TERMS + 1, max(len(self.points), 1))
        days = F.array(*[F.lit(float(p)) for p in self.points]).cast("array<double>")
        rows = self.coefficients.select(*keys, F.explode(F.arrays_zip(days.alias("day"), bends.alias("change"))).alias("c"))
        return rows.select(*keys, "c.day", "c.change").where("change <> 0")

    def _transform(self, df: DataFrame) -> DataFrame:
        keys, t = self._keys(), self.getOrDefault(self.timeCol)
        yhat = None
        for i, b in enumerate(basis(F.col(t), self.origin_day, self.points)):
            term = F.get(F.col("coef"), i) * b
            yhat = term if yhat is None else yhat + term
        scored = null_safe_join(df, self.coefficients.select(*keys, "coef"), keys)
        return scored.withColumn(self.getPredictionCol(), yhat).drop("coef")
