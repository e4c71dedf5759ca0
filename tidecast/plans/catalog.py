"""Registered queries: one per operator of the inventory, each reading the
whole driver tables from ``sf_dir``.

Outputs are shaped for comparison with the DuckDB statements in
:mod:`tidecast.plans.oracle`: floating results are rounded (sum order differs
between engines), dates are rendered as ISO strings, and every computed
column carries the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.columns import day_index, day_number, dept_key, revenue, series_key
from tidecast.models.boosting import HistGBTRegressor, best_splits, bin_edges, histogram, split_gains, with_bins
from tidecast.models.changepoints import ChangePointForecaster
from tidecast.models.rolling import backtest, backtest_rmse
from tidecast.functions.metrics import rmse
from tidecast.models.selection import (join_pred_actual, load_model, on_common_rows, rmse_by_model, save_model,
                                       select_best_model)
from tidecast.models.series import FourierForecaster, TrendWeekdayForecaster
from tidecast.models.trees import gbt, rmse_of, tune
from tidecast.models.trials import TrialLog, halving
from tidecast.operators.labels import label_table
from tidecast.operators.joins import inner_join_on, left_join_using
from tidecast.operators.reshape import melt
from tidecast.operators.split import cutoff_side, distributed_percent_rank, time_percent_rank, time_split
from tidecast.operators.stages import ZeroReplacer, null_profile
from tidecast.plans import features as fe
from tidecast.plans.items import ITEM, item_forecasts
from tidecast.plans.wide import sales_by_day, wide_tables
from tidecast.session import scratch_path
from tidecast.sources.files import read_csv, read_csv_by_name, read_parquet, write_csv, write_parquet
from tidecast.sources.retail import DAY_ORIGIN, retail_lines
from tidecast.sources.tables import read_table

# Forecast origin for the per-series families (the reference passes a date
# string the same way); the chronological split ratio of the trees.
FORECAST_CUTOFF = "2000-06-30"
SPLIT_RATIO = 0.8
KEYS = [*fe.SERIES, fe.TIME]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _r(c: str, digits: int) -> F.Column:
    return F.round(F.col(c), digits).alias(c)


def _r0(c: str, digits: int) -> F.Column:
    """Rounded, and 0.0 where that gives -0.0."""
    return (F.round(F.col(c), digits) + F.lit(0.0)).alias(c)


def _date_str(c: str) -> F.Column:
    return F.col(c).cast("date").cast("string").alias(c)


# ---------------------------------------------------------------- features

def q_daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    daily = fe.daily_sales(spark, sf)
    return daily.select(*[c for c in daily.columns if c not in ("date", "sales")],
                        _date_str("date"), _r("sales", 2))


def _logged(spark: SparkSession, sf: str) -> DataFrame:
    """Single-consumer form: one lazy plan, one pass over the fact table."""
    return fe.log_sales(fe.daily_sales(spark, sf))


def _logged_once(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-consumer form. Filters on the date are pushed below the daily
    sum, so branches of one plan would not share its exchange and each would
    scan the fact table again; the small daily table (series x days) is
    written once to the checkpoint folder and every branch reads that."""
    return fe.log_sales(fe.materialize(fe.daily_sales(spark, sf)))


def q_log_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _logged(spark, sf).select(*KEYS, _r("sales", 2), _r(fe.LABEL, 6))


def q_lag_features(spark: SparkSession, sf: str) -> DataFrame:
    lagged = fe.lag_features(_logged(spark, sf))
    return lagged.select(*KEYS, *[_r(c, 6) for c in fe.LAG_COLS])


def q_impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    # The imputer's fit is a job of its own, then the transform reads again.
    imputed = fe.impute_lags(fe.lag_features(_logged_once(spark, sf)))
    return imputed.select(*KEYS, *[_r(c, 6) for c in fe.LAG_COLS])


def q_time_percent_rank(spark: SparkSession, sf: str) -> DataFrame:
    ranked = time_percent_rank(_logged_once(spark, sf), fe.TIME, "rank")
    return ranked.select(*KEYS, _r("rank", 6))


def q_split_train(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = time_split(_logged_once(spark, sf), fe.TIME, SPLIT_RATIO)
    return train.select(*KEYS, _r(fe.LABEL, 6))


def q_split_test(spark: SparkSession, sf: str) -> DataFrame:
    _, test = time_split(_logged_once(spark, sf), fe.TIME, SPLIT_RATIO)
    return test.select(*KEYS, _r(fe.LABEL, 6))


def _encoded(spark: SparkSession, sf: str) -> DataFrame:
    daily = fe.materialize(fe.daily_sales(spark, sf))
    imputed = fe.impute_lags(fe.lag_features(fe.log_sales(daily)))
    return fe.encoder().fit(imputed).transform(imputed)


def q_string_index(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(spark, sf).select(*KEYS, *fe.INDEXED)


def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    enc = _encoded(spark, sf)

    def slots(feature: str) -> F.Column:
        return F.transform(vector_to_array(feature), lambda v, i: F.struct(
            F.lit(feature).alias("feature"), i.cast("int").alias("slot"), v.alias("value")))

    return enc.select(*KEYS, F.explode(F.concat(*map(slots, fe.ENCODED))).alias("s")).select(*KEYS, "s.*")


def q_encoded_features(spark: SparkSession, sf: str) -> DataFrame:
    assembled = fe.assembler().transform(_encoded(spark, sf))
    entries = assembled.select(*KEYS, F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return entries.select(*KEYS, F.col("slot").cast("int"), _r("value", 6))


# ---------------------------------------------------------------- reshaping

def q_melt(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", *MEASURES])
    return melt(lines, ["l_orderkey", "l_linenumber"], MEASURES, "variable", "value")


def q_series_key(spark: SparkSession, sf: str) -> DataFrame:
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return cust.select("c_custkey", series_key("c_name", "c_mktsegment", suffix="evaluation").alias("id"))


def q_dept_key(spark: SparkSession, sf: str) -> DataFrame:
    part = read_table(spark, sf, "part", ["p_partkey", "p_name"])
    return part.select("p_partkey", dept_key("p_name", sep=" ").alias("dept_id"))


def q_day_index(spark: SparkSession, sf: str) -> DataFrame:
    part = read_table(spark, sf, "part", ["p_partkey", "p_brand"])
    return part.select("p_partkey", day_index("p_brand", prefix="Brand#").alias("brand_no"))


def q_revenue(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])
    part = read_table(spark, sf, "part", ["p_partkey", "p_retailprice"])
    joined = inner_join_on(lines, part, [("l_partkey", "p_partkey")])
    return joined.select("l_orderkey", "l_linenumber",
                         F.round(revenue("l_quantity", "p_retailprice"), 2).alias("revenue"))


def q_replace_zero(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_discount", "l_tax"])
    return ZeroReplacer(inputCols=["l_discount"]).transform(lines)


# ---------------------------------------------------------------- joins

def q_join_left_using(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with their labels, which cover some of them."""
    docs = read_table(spark, sf, "documents", ["doc_id", "lang", "source", "n_chars"])
    labels = read_table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    return left_join_using(docs, labels, "doc_id")


def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return null_profile(q_join_left_using(spark, sf))


def q_join_inner_multikey(spark: SparkSession, sf: str) -> DataFrame:
    """Every line and measure with the order's total of that measure: lines and
    totals meet on (order, measure). Both sides have every measure of an order,
    so they are joined by order while still wide, and the matched pairs are
    melted after it: a quarter of the rows is shuffled. (The two-key join as
    such is that of the prices in the wide job, on series and week.)"""
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", *MEASURES])
    totals = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.sum(m).alias(f"total_{m}") for m in MEASURES])
    joined = inner_join_on(lines.withColumnRenamed("l_orderkey", "okey"), totals, [("okey", "o_orderkey")])
    pairs = F.array(*[F.struct(F.lit(m).alias("variable"), F.col(m).alias("value"),
                               F.col(f"total_{m}").alias("order_total")) for m in MEASURES])
    return joined.select("okey", "l_linenumber", F.explode(pairs).alias("p")).select(
        "okey", "l_linenumber", "p.variable", "p.value", F.round("p.order_total", 4).alias("order_total"))


def q_cutoff_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return orders.select("o_orderkey", _date_str("o_orderdate"),
                         cutoff_side("o_orderdate", FORECAST_CUTOFF, "side"))


# ---------------------------------------------------------------- forecasts

def _trend_forecast(spark: SparkSession, sf: str) -> DataFrame:
    logged = _logged_once(spark, sf)
    model = TrendWeekdayForecaster(groupCols=fe.SERIES, cutoff=FORECAST_CUTOFF).fit(logged)
    future = logged.where(F.col("date") > F.lit(FORECAST_CUTOFF).cast("date"))
    return model.transform(future)


def q_forecast_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _trend_forecast(spark, sf).select(*KEYS, _r("yhat", 4))


def _naive_week(logged: DataFrame) -> DataFrame:
    """Seasonal-naive prediction: the same series' value seven days before."""
    return logged.select(*fe.SERIES, (F.col(fe.TIME) + 7).alias(fe.TIME), F.col(fe.LABEL).alias("yhat"))


def q_join_pred_actual(spark: SparkSession, sf: str) -> DataFrame:
    logged = _logged_once(spark, sf)
    actual = logged.select(*KEYS, F.col(fe.LABEL).alias("actual"))
    return join_pred_actual(actual, _naive_week(logged), KEYS).select(
        *KEYS, _r("actual", 6), _r("yhat", 6))


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    logged = _logged_once(spark, sf)
    after = F.col("date") > F.lit(FORECAST_CUTOFF).cast("date")
    model = TrendWeekdayForecaster(groupCols=fe.SERIES, cutoff=FORECAST_CUTOFF).fit(logged)
    trend = model.transform(logged.where(after)).select(
        F.lit("trend_weekday").alias("model"), F.lit("series").alias("family"),
        *KEYS, fe.LABEL, "yhat")
    naive = join_pred_actual(logged.where(after), _naive_week(logged), KEYS).select(
        F.lit("seasonal_naive").alias("model"), F.lit("baseline").alias("family"),
        *KEYS, fe.LABEL, "yhat")
    scored = on_common_rows(trend.unionByName(naive), KEYS, ["trend_weekday", "seasonal_naive"], fe.LABEL, "yhat")
    return rmse_by_model(scored, fe.LABEL, "yhat", "model", by=["family", "store_id"])


def q_rmse_by_model(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf).select("model", "store_id", _r("rmse", 6), "n")


def q_select_best_model(spark: SparkSession, sf: str) -> DataFrame:
    best = select_best_model(_scores(spark, sf), by=["store_id"])
    return best.select("store_id", "model", "family", _r("rmse", 6))


# Origins of the rolling evaluation, and days that items are forecast for.
ORIGINS = ["1998-12-31", "1999-12-31", "2000-12-31"]
HORIZON = 28


def _backtest_scores(spark: SparkSession, sf: str) -> DataFrame:
    return backtest_rmse(backtest(_logged_once(spark, sf), fe.SERIES, fe.TIME, "date", fe.LABEL, ORIGINS))


def q_backtest_rmse(spark: SparkSession, sf: str) -> DataFrame:
    return _backtest_scores(spark, sf).select("fold", "model", _r("rmse", 6), "n")


def q_trial_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the rolling evaluation kept as trials, with one that failed
    in each fold; the choice of each fold is a query over the table."""
    scores = _backtest_scores(spark, sf).select(
        F.concat_ws("-", "fold", "model").alias("trial_key"), F.col("fold").cast("string").alias("data_key"),
        F.col("model").alias("family"), F.create_map(F.lit("model"), "model").alias("params"), F.lit(0).alias("budget"),
        F.col("rmse").alias("loss"), F.lit("ok").alias("status"))
    failed = scores.groupBy("data_key").agg(F.lit(1)).select(
        F.concat_ws("-", "data_key", F.lit("failed")).alias("trial_key"), "data_key", F.lit("failed").alias("family"),
        F.create_map(F.lit("model"), F.lit("failed")).alias("params"), F.lit(0).alias("budget"),
        F.lit(-1.0).alias("loss"), F.lit("fail").alias("status"))
    trials = TrialLog(spark, scratch_path(spark, "trials"))
    trials.append(scores.unionByName(failed))
    return trials.best().select(F.col("data_key").cast("int").alias("fold"), F.col("family").alias("model"),
                                _r("loss", 6))


def _item_forecasts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = retail_lines(spark, sf)
    sales = fe.materialize(lines.groupBy(*ITEM, "day", "date").agg(F.sum("sales").alias("sales")), "item-sales")
    last = spark.range(1).select(day_number(F.lit(FORECAST_CUTOFF), DAY_ORIGIN)).first()[0]
    return item_forecasts(sales, last, HORIZON)


def q_forecast_item(spark: SparkSession, sf: str) -> DataFrame:
    """Every store and item, 28 days ahead, as fitted and as reconciled."""
    items, _ = _item_forecasts(spark, sf)
    return items.select(*ITEM, "day", _r0("yhat", 1), _r0("reconciled", 1))


def q_forecast_reconciled(spark: SparkSession, sf: str) -> DataFrame:
    """Departments as fitted and as reconciled, with the sum of their items."""
    items, depts = _item_forecasts(spark, sf)
    by = [*fe.SERIES, fe.TIME]
    total = items.groupBy(*by).agg(F.sum("reconciled").alias("item_sum"), F.count(F.lit(1)).alias("n_items"))
    return depts.join(total, by).select(*by, _r0("yhat", 2), _r0("reconciled", 2), _r0("item_sum", 2), "n_items")


def q_event_percent_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Exact rank over nearly as many times as rows: no task sorts them all."""
    events = read_table(spark, sf, "events", ["event_id", "ts"])
    return distributed_percent_rank(events, "ts").select("event_id", _r("rank", 9))


def q_label_index(spark: SparkSession, sf: str) -> DataFrame:
    """Index of every item by its number of lines, without the driver."""
    return label_table(read_table(spark, sf, "lineitem", ["l_partkey"]), "l_partkey").select("label", "n", "index")


def q_fourier_normal_equations(spark: SparkSession, sf: str) -> DataFrame:
    """X'X (upper half) and X'y of every series' Fourier fit, entry by entry."""
    est = FourierForecaster(groupCols=fe.SERIES, cutoff=FORECAST_CUTOFF)
    partial, _ = est.partials(_logged_once(spark, sf))
    size = F.size("xty")
    rows = F.flatten(F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.transform(
        F.sequence(i, size - 1), lambda j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j")))))
    right = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(i.cast("int").alias("i"), F.lit(-1).alias("j")))
    entries = F.arrays_zip(F.concat(rows, right).alias("at"), F.concat("xtx", "xty").alias("value"))
    cells = partial.select(*fe.SERIES, F.explode(entries).alias("e"))
    return cells.groupBy(*fe.SERIES, F.col("e.at.i").alias("i"), F.col("e.at.j").alias("j")) \
        .agg((F.round(F.sum("e.value"), 4) + F.lit(0.0)).alias("value"))


# ------------------------------------------------ models without a SQL oracle

def _split_features(spark: SparkSession, sf: str):
    """Assembled features with their time rank, fitted on the train rows and
    written once; train and test are then plain filters over the written
    table. ``_rank`` stays on the train rows, to split off a validation part."""
    return _parts(fe.build_features(spark, sf, train_ratio=SPLIT_RATIO))


def _parts(features: fe.FeatureSet) -> tuple[DataFrame, DataFrame]:
    ranked = fe.materialize(features.assembled, "features")
    train = ranked.where(F.col("_rank") <= F.lit(SPLIT_RATIO))
    test = ranked.where(F.col("_rank") > F.lit(SPLIT_RATIO)).drop("_rank")
    return train, test


def q_gbt_rmse(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split_features(spark, sf)
    model = gbt(max_depth=2, max_iter=10).fit(train)
    loss = rmse_of(model, test)
    return spark.createDataFrame([(2, 10, train.count(), test.count(), loss)],
                                 "max_depth int, max_iter int, n_train long, n_test long, rmse double")


#: Inputs of the split report; zero discounts and taxes count as missing.
SPLIT_INPUTS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def q_hist_gbt_splits(spark: SparkSession, sf: str) -> DataFrame:
    """First level of a boosted tree for the price of a line: of each input the
    best cut, its gain and the side of missing values, and which is chosen."""
    lines = read_table(spark, sf, "lineitem", [*SPLIT_INPUTS, "l_extendedprice"])
    features = F.array(*[F.col(c).cast("double") for c in SPLIT_INPUTS])
    lines = lines.select(features.alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    mean = lines.agg(F.avg("y")).first()[0]
    edges = bin_edges(lines, F.col("x"), len(SPLIT_INPUTS), 32, 0.0, "uniform")
    rows = with_bins(lines, F.col("x"), edges, 0.0, F.lit(0).alias("node"),
                     (F.col("y") - F.lit(mean)).cast("double").alias("g"))
    gains = split_gains(histogram(rows, len(edges)), reg_lambda=1.0)
    best = fe.materialize(best_splits(gains, ["feature"]), "splits")
    top = best_splits(best.withColumn("node", F.lit(0)), ["node"]).select("feature", F.lit(True).alias("chosen"))
    names = F.array(*[F.lit(c) for c in SPLIT_INPUTS])
    return best.join(top, "feature", "left").select(
        F.get(names, F.col("feature")).alias("input"), "bin", "missing_left", F.round("gain", 2).alias("gain"),
        F.coalesce("chosen", F.lit(False)).alias("chosen"))


def q_hist_gbt_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """Boosting with a missing direction (zeros missing, as in the reference)
    against Spark's trees: same rows, depth and number of trees."""
    train, test = _split_features(spark, sf)
    models = {"hist": HistGBTRegressor(maxDepth=2, maxIter=10, missing=0.0), "gbt": gbt(max_depth=2, max_iter=10)}
    scored = [est.fit(train).transform(test).select(F.lit(name).alias("model"), fe.LABEL, "prediction")
              for name, est in models.items()]
    return rmse_by_model(reduce(DataFrame.unionByName, scored), fe.LABEL, "prediction")


def q_tune_trials(spark: SparkSession, sf: str) -> DataFrame:
    """The whole grid, scored on the last part of the train rows."""
    train, _ = _split_features(spark, sf)
    early = F.col("_rank") <= F.lit(SPLIT_RATIO * SPLIT_RATIO)
    return tune(spark, train.where(early), train.where(~early), parallelism=4).trials


def q_halving_trials(spark: SparkSession, sf: str) -> DataFrame:
    """The same grid by halving: both depths with ten trees, the better one
    with a hundred; then once more, which finds every trial in the table."""
    train, _ = _split_features(spark, sf)
    early = F.col("_rank") <= F.lit(SPLIT_RATIO * SPLIT_RATIO)
    trials = TrialLog(spark, scratch_path(spark, "halving"))
    for _ in range(2):
        found = halving(trials, "features", train.where(early), train.where(~early), {"maxDepth": [2, 5]}, [10, 100])
    best = trials.best().select("trial_key", F.lit(True).alias("chosen"))
    return found.join(best, "trial_key", "left").select(
        "family", F.element_at("params", F.lit("maxDepth")).cast("int").alias("max_depth"), F.col("budget").alias("max_iter"),
        "loss", "status", F.coalesce("chosen", F.lit(False)).alias("chosen"))


def q_forecast_fourier(spark: SparkSession, sf: str) -> DataFrame:
    logged = _logged_once(spark, sf)
    model = FourierForecaster(groupCols=fe.SERIES, cutoff=FORECAST_CUTOFF).fit(logged)
    future = logged.where(F.col("date") > F.lit(FORECAST_CUTOFF).cast("date"))
    return model.transform(future).select(*KEYS, _date_str("date"), fe.LABEL, "yhat")


def q_forecast_changepoint(spark: SparkSession, sf: str) -> DataFrame:
    """The Fourier forecast with a trend that may bend."""
    logged = _logged_once(spark, sf)
    model = ChangePointForecaster(groupCols=fe.SERIES, cutoff=FORECAST_CUTOFF).fit(logged)
    future = logged.where(F.col("date") > F.lit(FORECAST_CUTOFF).cast("date"))
    return model.transform(future).select(*KEYS, _date_str("date"), fe.LABEL, "yhat")


def model_choice(spark: SparkSession, sf: str, grid: dict | None = None) -> DataFrame:
    """The end-to-end run: features -> chronological split -> tuned trees,
    Fourier and trend+weekday forecasts scored on the same test rows at the
    same (log) scale and grain -> per-model RMSE and the chosen model.

    The grid point is picked on the last part of the train rows, then fitted
    on all of them. ``horizon`` says what a model knows: trees see the true
    values of the days before (one step), the series families none after the
    train rows (full). No tree model is scored if every trial failed."""
    return _choose(spark, *_split_features(spark, sf), grid)


def q_wide_model_choice(spark: SparkSession, sf: str) -> DataFrame:
    """The same run from files: wide sales, prices and calendar as CSV ->
    features -> tuned trees and forecasts -> the chosen model."""
    return _choose(spark, *_parts(fe.feature_set(_wide_daily(spark, sf), SPLIT_RATIO)), {"maxDepth": [2, 5], "maxIter": [10]})


def q_cutoff_model_choice(spark: SparkSession, sf: str) -> DataFrame:
    """The same run split at a date, as the reference's forecasts are, with the
    chosen model kept: it is loaded from its folder and scores the test rows
    once more (``reloaded``; of the other models null)."""
    daily = fe.materialize(fe.daily_sales(spark, sf))
    table = fe.materialize(fe.feature_set(daily, cutoff=FORECAST_CUTOFF).assembled, "features")
    train, test = table.where(F.col("_rank").isNotNull()), table.where(F.col("_rank").isNull()).drop("_rank")
    kept = scratch_path(spark, "chosen")
    scores = _choose(spark, train, test, {"maxDepth": [2], "maxIter": [10]}, SPLIT_RATIO, kept)
    model = load_model(spark, kept)
    again = model.transform(test).select(F.lit(True).alias("chosen"), fe.LABEL, F.col(model.getPredictionCol()).alias("yhat"))
    reloaded = again.groupBy("chosen").agg(rmse(fe.LABEL, "yhat").alias("reloaded"))
    return scores.join(reloaded, "chosen", "left").select("model", "family", "horizon", "rmse", "n", "chosen", "reloaded")


def _choose(spark: SparkSession, train: DataFrame, test: DataFrame, grid: dict | None,
            early_rank: float = SPLIT_RATIO * SPLIT_RATIO, keep: str | None = None) -> DataFrame:
    """Scores of all models on the same test rows. The grid point is picked on
    the train rows after ``early_rank``; the chosen model is saved to ``keep``."""
    early = F.col("_rank") <= F.lit(early_rank)
    result = tune(spark, train.where(early), train.where(~early), grid=grid, parallelism=4)
    fitted = {}
    if result.best_model is not None:
        est = gbt(max_depth=result.best_params["maxDepth"], max_iter=result.best_params["maxIter"])
        fitted["trees"] = est.fit(train), "trees", "one step"
    for name, est in (("fourier", FourierForecaster(groupCols=fe.SERIES)),
                      ("trend_weekday", TrendWeekdayForecaster(groupCols=fe.SERIES))):
        fitted[name] = est.fit(train), "series", "full"
    parts = [model.transform(test).select(
        F.lit(name).alias("model"), F.lit(family).alias("family"), F.lit(horizon).alias("horizon"), *KEYS, fe.LABEL,
        F.col(model.getPredictionCol()).alias("yhat")) for name, (model, family, horizon) in fitted.items()]
    scored = on_common_rows(reduce(DataFrame.unionByName, parts), KEYS, list(fitted), fe.LABEL, "yhat")
    # A few rows, read twice below: written, so that scoring runs once.
    scores = fe.materialize(rmse_by_model(scored, fe.LABEL, "yhat", "model", by=["family", "horizon"]), "scores")
    best = select_best_model(scores).select("model", F.lit(True).alias("chosen"))
    if keep:
        save_model(fitted[best.first()["model"]][0], keep)
    return scores.join(best, "model", "left").select(
        "model", "family", "horizon", "rmse", "n", F.coalesce("chosen", F.lit(False)).alias("chosen"))


# ---------------------------------------------------------------- sources/sinks

def q_scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem")
    path = write_csv(lines, scratch_path(spark, "lineitem-csv"))
    back = read_csv(spark, path, lines.schema)
    return back.select(*[c for c in back.columns if c != "l_shipdate"],
                       F.col("l_shipdate").cast("string").alias("l_shipdate"))


def q_wide_daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job from its own inputs: wide sales, prices and calendar as
    CSV -> daily revenue of each store and department."""
    days = sales_by_day(*wide_tables(spark, sf))
    return days.select(*[c for c in days.columns if c not in ("date", "sales")], _date_str("date"), _r("sales", 2))


def _wide_daily(spark: SparkSession, sf: str) -> DataFrame:
    return fe.materialize(sales_by_day(*wide_tables(spark, sf)), "wide-daily")


def q_wide_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features of the same job: log, lags and their fill from the daily table
    that came from files."""
    logged = fe.feature_set(_wide_daily(spark, sf)).imputed
    return logged.select(*KEYS, _r(fe.LABEL, 6), *[_r(c, 6) for c in fe.LAG_COLS])


def q_scan_csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as CSV with columns in another order and one more, and in every
    seventh order a date that is none: columns are bound by name, and the
    rejected records are counted, file by file or, as here, in all."""
    lines = read_table(spark, sf, "lineitem")
    when = F.when(F.col("l_orderkey") % 7 == 0, F.lit("soon")).otherwise(F.col("l_shipdate").cast("date").cast("string"))
    order = ["l_shipdate", "l_tax", "l_linenumber", "comment", "l_orderkey", "l_quantity"]
    path = write_csv(lines.withColumn("l_shipdate", when).withColumn("comment", F.lit("a, b")).select(*order),
                     scratch_path(spark, "by-name"))
    rows, rejected = read_csv_by_name(spark, path, {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
                                                    "l_shipdate": "date"})
    refused = rejected.agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("l_shipdate").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")) \
        .select(_date_str("l_shipdate"), "n_lines", _r("quantity", 2)) \
        .unionByName(refused.select(F.lit("rejected").alias("l_shipdate"), F.col("n").alias("n_lines"),
                                    F.lit(0.0).alias("quantity")))


def q_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    daily = fe.daily_sales(spark, sf)
    path = write_parquet(daily, scratch_path(spark, "daily"), partition_by=["store_id"])
    back = read_parquet(spark, path)
    return back.select(*KEYS, _date_str("date"), _r("sales", 2))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_csv": q_scan_csv,
    "sink_roundtrip": q_sink_roundtrip,
    "scan_csv_by_name": q_scan_csv_by_name,
    "wide_daily_sales": q_wide_daily_sales,
    "wide_features": q_wide_features,
    "series_key": q_series_key,
    "melt": q_melt,
    "day_index": q_day_index,
    "dept_key": q_dept_key,
    "revenue": q_revenue,
    "replace_zero": q_replace_zero,
    "join_left_using": q_join_left_using,
    "join_inner_multikey": q_join_inner_multikey,
    "null_profile": q_null_profile,
    "cutoff_split": q_cutoff_split,
    "daily_sales": q_daily_sales,
    "log_sales": q_log_sales,
    "lag_features": q_lag_features,
    "impute_mean": q_impute_mean,
    "time_percent_rank": q_time_percent_rank,
    "split_train": q_split_train,
    "split_test": q_split_test,
    "string_index": q_string_index,
    "one_hot": q_one_hot,
    "encoded_features": q_encoded_features,
    "forecast_trend": q_forecast_trend,
    "join_pred_actual": q_join_pred_actual,
    "rmse_by_model": q_rmse_by_model,
    "select_best_model": q_select_best_model,
    "backtest_rmse": q_backtest_rmse,
    "trial_choice": q_trial_choice,
    "forecast_item": q_forecast_item,
    "forecast_reconciled": q_forecast_reconciled,
    "event_percent_rank": q_event_percent_rank,
    "label_index": q_label_index,
    "fourier_normal_equations": q_fourier_normal_equations,
    "hist_gbt_splits": q_hist_gbt_splits,
    "hist_gbt_rmse": q_hist_gbt_rmse,
    "gbt_rmse": q_gbt_rmse,
    "tune_trials": q_tune_trials,
    "halving_trials": q_halving_trials,
    "forecast_fourier": q_forecast_fourier,
    "forecast_changepoint": q_forecast_changepoint,
    "model_choice": model_choice,
    "wide_model_choice": q_wide_model_choice,
    "cutoff_model_choice": q_cutoff_model_choice,
}
