"""Rolling-origin evaluation from prefix sums.

Each origin (a cutoff date) trains on all rows up to it and is tested on the
rows up to the next one. The rows are read once: they are summed by series,
weekday and segment between origins; what an origin trains on is the sum of
the segments before it, so no fit reads a row again. The summed table has at
most series x 7 x (origins + 1) rows.

Models: ``level`` (mean), ``trend`` (least squares line) and ``trend_weekday``
(the line and the mean residual of each weekday, zero for a weekday without
training rows).

Defined results: rows without a label are left out; a null key is a key; a
series without training rows, or without two different training days for the
line, has no prediction and is not scored; an origin without test rows has no
score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.metrics import rmse
from tidecast.operators.joins import null_safe_join

MODELS = ("level", "trend", "trend_weekday")
_SUMS = ("n", "st", "sy", "stt", "sty")


def segment(date: Column, origins: Sequence[str]) -> Column:
    """Number of origins before a date: 0 up to the first one."""
    out = F.lit(0)
    for origin in sorted(origins):
        out = out + F.when(date > F.lit(origin).cast("date"), 1).otherwise(0)
    return out.cast("int")


def prefix_sums(rows: DataFrame, keys: Sequence[str], origins: int) -> DataFrame:
    """(keys, fold, dow, sums of the normal equations over all segments before
    the fold), from ``rows(keys, segment, dow, t, y)``."""
    t, y = F.col("t"), F.col("y")
    sums = rows.groupBy(*keys, "segment", "dow").agg(
        F.count(F.lit(1)).alias("n"), F.sum(t).alias("st"), F.sum(y).alias("sy"), F.sum(t * t).alias("stt"),
        F.sum(t * y).alias("sty"))
    later = sums.where(F.col("segment") < origins).withColumn(
        "fold", F.explode(F.sequence(F.col("segment") + 1, F.lit(origins))))
    return later.groupBy(*keys, "fold", "dow").agg(*[F.sum(c).alias(c) for c in _SUMS])


def coefficients(prefix: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, fold, level, slope, intercept), from the prefix sums."""
    whole = prefix.groupBy(*keys, "fold").agg(*[F.sum(c).alias(c) for c in _SUMS])
    n, st, sy, stt, sty = (F.col(c) for c in _SUMS)
    spread = n * stt - st * st
    slope = F.when(spread > 0, (n * sty - st * sy) / spread)
    return whole.select(*keys, "fold", (sy / n).alias("level"), slope.alias("slope"),
                        ((sy - slope * st) / n).alias("intercept"))


def weekday_effects(prefix: DataFrame, fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    met = null_safe_join(prefix, fitted, [*keys, "fold"], "inner")
    effect = (F.col("sy") - F.col("intercept") * F.col("n") - F.col("slope") * F.col("st")) / F.col("n")
    return met.select(*keys, "fold", "dow", effect.alias("effect"))


def backtest(rows: DataFrame, keys: Sequence[str], time_col: str, date_col: str, label_col: str,
             origins: Sequence[str]) -> DataFrame:
    """(keys, fold, time, label, model, yhat) of every test row and model; fold
    i is tested between origin i and the next."""
    date = F.col(date_col).cast("date")
    known = rows.where(F.col(label_col).isNotNull()).select(
        *keys, segment(date, origins).alias("segment"), F.dayofweek(date).alias("dow"),
        F.col(time_col).cast("double").alias("t"), F.col(label_col).cast("double").alias("y"))
    prefix = prefix_sums(known, keys, len(origins))
    fitted = coefficients(prefix, keys)
    tested = known.where("segment > 0").withColumnRenamed("segment", "fold")
    scored = null_safe_join(null_safe_join(tested, fitted, [*keys, "fold"], "inner"),
                            weekday_effects(prefix, fitted, keys), [*keys, "fold", "dow"])
    line = F.col("intercept") + F.col("slope") * F.col("t")
    yhat = {"level": F.col("level"), "trend": line, "trend_weekday": line + F.coalesce("effect", F.lit(0.0))}
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), yhat[m].alias("yhat")) for m in MODELS]))
    return scored.select(*keys, "fold", "t", "y", each.alias("m")).select(*keys, "fold", "t", "y", "m.model", "m.yhat")


def backtest_rmse(predicted: DataFrame) -> DataFrame:
    """(fold, model, rmse, n) over the rows with a prediction."""
    return predicted.where("yhat IS NOT NULL").groupBy("fold", "model").agg(
        rmse("y", "yhat").alias("rmse"), F.count(F.lit(1)).alias("n"))
