"""The feature plan: order lines -> daily revenue per (store, department) ->
calendar -> zero replacement -> log -> 12 lags -> mean imputation ->
categorical encoding -> feature vector.

Revenue is summed on the three keys (store, department, day) and the calendar
is attached afterwards: the day determines every calendar attribute, so this
gives the same groups as summing on all sixteen columns while shuffling three
keys. After the sum the table has one row per series and day, so every later
stage works on a table bounded by (#series x #days), not by raw volume.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.joins import left_join_using
from tidecast.operators.split import cutoff_split, time_percent_rank
from tidecast.operators.stages import DailySum, LagFeatures, LogTransformer, MeanImputer, ZeroReplacer
from tidecast.session import materialize
from tidecast.sources.retail import CALENDAR_COLUMNS, DAY_ORIGIN, calendar_columns, retail_lines

SERIES = ["store_id", "dept_id"]
TIME = "day"
LABEL = "LogSales"
LAG_PREFIX = "LagFeatures"
NUM_LAGS = 12
LAG_COLS = [f"{LAG_PREFIX}{i}" for i in range(1, NUM_LAGS + 1)]

# The dataset's column names and the order of the model inputs.
# Columns indexed as categories; the first two are also one-hot encoded.
STRING_COLS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2",
               "year", "dept_id", "store_id"]
ONE_HOT_COLS = ["event_name_1", "event_type_1"]
INDEXED = [f"{c}_indexed" for c in STRING_COLS]
ENCODED = [f"{c}_encoded" for c in ONE_HOT_COLS]

# Model inputs, in vector slot order: numeric calendar columns, lags, the
# department and store indexes, then the two one-hot blocks.
FEATURE_COLS = (["day", "wday", "month", "snap_CA", "snap_TX", "snap_WI"] + LAG_COLS
                + ["dept_id_indexed", "store_id_indexed"] + ENCODED)


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(store_id, dept_id, day, sales) plus the calendar columns of the day.

    Here the calendar is a pure function of the date, so its columns are
    computed in the projection after the sum: no join, and no second pass
    over the fact table to find the date range. A calendar that comes as a
    table is attached with :func:`with_calendar`.
    """
    lines = retail_lines(spark, sf_dir)
    daily = DailySum(inputCol="sales", outputCol="sales", groupCols=SERIES + [TIME]).transform(lines)
    date = F.date_add(F.lit(DAY_ORIGIN).cast("date"), F.col(TIME) - 1)
    cal = calendar_columns(date)
    return daily.select(*SERIES, TIME, *[cal[c].alias(c) for c in CALENDAR_COLUMNS if c != TIME],
                        "sales")


def with_calendar(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Attach a user-supplied calendar table (left join USING day)."""
    return left_join_using(daily, calendar, TIME)


def log_sales(daily: DataFrame) -> DataFrame:
    """Zeros to 0.5 in ``sales`` only, then ``LogSales = ln(sales)``."""
    stages = Pipeline(stages=[ZeroReplacer(inputCols=["sales"]),
                              LogTransformer(inputCol="sales", outputCol=LABEL)])
    return stages.fit(daily).transform(daily)


def lag_features(logged: DataFrame, num_lags: int = NUM_LAGS) -> DataFrame:
    return LagFeatures(inputCol=LABEL, outputCol=LAG_PREFIX, numLags=num_lags,
                       timeCol=TIME, partitionCols=["dept_id", "store_id"]).transform(logged)


def impute_lags(lagged: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Fill lag nulls with the lag averages of ``fit_on`` (default: all rows,
    i.e. fill before the split)."""
    imputer = MeanImputer(inputCols=LAG_COLS).fit(fit_on if fit_on is not None else lagged)
    return imputer.transform(lagged)


def encoder() -> Pipeline:
    """String indexes for the 7 categorical columns (null and unseen -> an
    extra bucket) and one-hot vectors for the two event columns, where that
    bucket becomes the all-zero vector."""
    return Pipeline(stages=[
        StringIndexer(inputCols=STRING_COLS, outputCols=INDEXED, handleInvalid="keep",
                      stringOrderType="frequencyDesc"),
        # Default handleInvalid: the index's own extra bucket is the last
        # category, which dropLast turns into the all-zero vector.
        OneHotEncoder(inputCols=INDEXED[:2], outputCols=ENCODED, dropLast=True),
    ])


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_COLS, outputCol="features", handleInvalid="error")


@dataclass
class FeatureSet:
    """Outputs of :func:`build_features`, for callers that need the parts."""

    daily: DataFrame
    logged: DataFrame
    lagged: DataFrame
    imputed: DataFrame
    encoded: DataFrame
    assembled: DataFrame
    encoder_model: PipelineModel | None = field(default=None)


def feature_set(daily: DataFrame, train_ratio: float | None = None, cutoff: str | None = None) -> FeatureSet:
    """All feature stages over a daily table with its calendar columns, from
    whatever source; written once by the caller (it is small: one row per
    series and day), as several stages fit on it. With ``train_ratio`` the
    imputer and the encoder are fitted on the first part of the time axis only,
    and ``_rank`` is kept; with ``cutoff`` (a date) on the rows up to it, and
    ``_rank`` is their rank, null after the cutoff; otherwise on all rows."""
    if train_ratio is not None and cutoff is not None:
        raise ValueError("either a ratio or a cutoff")
    logged = log_sales(daily)
    lagged = lag_features(logged)
    extra = []
    if train_ratio is None and cutoff is None:
        imputed = impute_lags(lagged)
        enc_model = encoder().fit(imputed)
    else:
        if cutoff is None:
            ranked = time_percent_rank(lagged, TIME, "_rank")
            train = F.col("_rank") <= F.lit(train_ratio)
        else:
            before, after = cutoff_split(lagged, "date", cutoff)
            ranked = time_percent_rank(before, TIME, "_rank").unionByName(
                after.withColumn("_rank", F.lit(None).cast("double")))
            train = F.col("_rank").isNotNull()
        lagged = materialize(ranked, "ranked")
        imputed = impute_lags(lagged, lagged.where(train))
        enc_model = encoder().fit(imputed.where(train))
        extra = ["_rank"]
    encoded = enc_model.transform(imputed)
    assembled = assembler().transform(encoded).select(*SERIES, TIME, "date", LABEL, "features", *extra)
    return FeatureSet(daily, logged, lagged, imputed, encoded, assembled, enc_model)


def build_features(spark: SparkSession, sf_dir: str, checkpoint: bool = True,
                   train_ratio: float | None = None) -> FeatureSet:
    """:func:`feature_set` over the order tables in their retail roles."""
    daily = daily_sales(spark, sf_dir)
    return feature_set(materialize(daily) if checkpoint else daily, train_ratio)
