import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidecast.models.selection import join_pred_actual, on_common_rows, rmse_by_model, select_best_model
from tidecast.models.series import FourierForecaster, TrendWeekdayForecaster
from tidecast.models.trees import gbt, rmse_of, tune
from tidecast.sources.retail import DAY_ORIGIN

ORIGIN = datetime.date.fromisoformat(DAY_ORIGIN)


def _series(spark, fn, days, keys=("a",)):
    rows = [(k, d, ORIGIN + datetime.timedelta(days=d - 1), float(fn(k, d))) for k in keys for d in days]
    return spark.createDataFrame(rows, "s string, day int, date date, y double")


def test_trend_recovers_line(spark):
    df = _series(spark, lambda k, t: 2 * t - 1, range(1, 60))
    model = TrendWeekdayForecaster(labelCol="y", groupCols=["s"]).fit(df)
    coef = model.trend.first()
    assert abs(coef.slope - 2) < 1e-9 and abs(coef.intercept + 1) < 1e-9
    pred = model.transform(_series(spark, lambda k, t: 0, [100]))
    assert abs(pred.first().yhat - 199) < 1e-6


def test_trend_weekday_effect_and_cutoff(spark):
    eff = {1: 3.0, 2: -1.0, 3: 0.0, 4: 0.5, 5: -0.5, 6: 1.0, 7: -3.0}
    def f(k, t):
        dow = (ORIGIN + datetime.timedelta(days=t - 1)).isoweekday() % 7 + 1
        return 10 + 0.1 * t + eff[dow]
    df = _series(spark, f, range(1, 141))
    cutoff = str(ORIGIN + datetime.timedelta(days=111))
    model = TrendWeekdayForecaster(labelCol="y", groupCols=["s"], cutoff=cutoff).fit(df)
    test = df.where(F.col("date") > F.lit(cutoff).cast("date"))
    scored = model.transform(test)
    # Two-step fit (trend, then mean residual per weekday): the weekday
    # pattern leaks a little into the slope, so the bound is loose; without
    # the weekday term the error would be as large as the effects (3.0).
    worst = scored.select(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert worst < 0.25


def test_fourier_recovers_trend_and_weekly_signal(spark):
    def f(k, t):
        return 5 + (0.3 if k == "a" else -0.2) * t / 365.25 + 0.8 * math.sin(2 * math.pi * t / 7)
    df = _series(spark, f, range(1, 800), keys=("a", "b"))
    train = df.where("day <= 700")
    model = FourierForecaster(labelCol="y", groupCols=["s"], regParam=1e-6).fit(train)
    scored = model.transform(df.where("day > 700"))
    err = scored.select(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert err < 0.05
    assert model.coefficients.count() == 2


def test_fourier_series_without_training_rows_gets_null(spark):
    df = _series(spark, lambda k, t: 1.0, range(1, 30), keys=("a",))
    other = _series(spark, lambda k, t: 1.0, [40], keys=("zz",))
    model = FourierForecaster(labelCol="y", groupCols=["s"]).fit(df)
    assert model.transform(other).first().yhat is None


def test_rmse_is_order_independent_and_keyed(spark):
    rng = random.Random(5)
    actual = [("a", d, float(d)) for d in range(50)]
    pred = [("a", d, float(d) + rng.choice([-1.0, 1.0])) for d in range(50)]
    rng.shuffle(pred)
    a = spark.createDataFrame(actual, "s string, day int, y double")
    p = spark.createDataFrame(pred, "s string, day int, yhat double").repartition(7)
    scored = join_pred_actual(a, p, ["s", "day"]).withColumn("model", F.lit("m"))
    r = rmse_by_model(scored, "y", "yhat").first()
    assert abs(r.rmse - 1.0) < 1e-12 and r.n == 50


def test_select_best_model_tie_goes_to_series(spark):
    scores = spark.createDataFrame(
        [("trees", "trees", 1.0), ("fourier", "series", 1.0), ("naive", "baseline", 2.0)],
        "model string, family string, rmse double")
    best = select_best_model(scores).first()
    assert (best.model, best.family) == ("fourier", "series")
    scores2 = spark.createDataFrame([("trees", "trees", 0.9), ("fourier", "series", 1.0)],
                                    "model string, family string, rmse double")
    assert select_best_model(scores2).first().model == "trees"


def test_gbt_beats_mean_and_tuning_records_trials(spark):
    from pyspark.ml.feature import VectorAssembler
    rng = random.Random(1)
    rows = [(float(x), float(3 * x + rng.gauss(0, 0.1))) for x in (rng.uniform(0, 10) for _ in range(400))]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame(rows, "x double, LogSales double"))
    train, test = df.where("x <= 8"), df.where("x > 8")
    model = gbt(max_depth=3, max_iter=10).fit(train)
    mean = train.agg(F.avg("LogSales")).first()[0]
    base = test.select(F.sqrt(F.avg(F.pow(F.col("LogSales") - F.lit(mean), 2)))).first()[0]
    assert rmse_of(model, test) < base
    result = tune(spark, train, test, grid={"maxDepth": [2, 3], "maxIter": [5]})
    trials = result.trials.collect()
    assert len(trials) == 2 and all(t.status == "ok" for t in trials)
    assert result.best_loss == min(t.loss for t in trials)


def test_forecaster_models_save_and_load(spark, tmp_path):
    from tidecast.models.series import FourierModel, TrendWeekdayModel

    df = _series(spark, lambda k, t: 1.0 + 0.01 * t + (0.5 if t % 7 == 0 else 0.0), range(1, 120), keys=("a", "b"))
    test = df.where("day > 100")
    for est, cls in ((TrendWeekdayForecaster(labelCol="y", groupCols=["s"]), TrendWeekdayModel),
                     (FourierForecaster(labelCol="y", groupCols=["s"]), FourierModel)):
        model = est.fit(df.where("day <= 100"))
        path = str(tmp_path / cls.__name__)
        model.save(path)
        loaded = cls.load(spark, path)
        assert loaded.getOrDefault(loaded.groupCols) == ["s"]
        a = sorted((r.s, r.day, round(r.yhat, 9)) for r in model.transform(test).collect())
        b = sorted((r.s, r.day, round(r.yhat, 9)) for r in loaded.transform(test).collect())
        assert a == b


def test_models_are_compared_on_common_rows(spark):
    rows = [("a", d, 1.0, "m", 1.0) for d in range(5)] + [("a", d, 1.0, "n", None if d < 2 else 3.0) for d in range(5)]
    rows += [(None, 1, 1.0, "m", 2.0), (None, 1, 1.0, "n", 2.0), ("a", 9, None, "m", 2.0), ("a", 9, None, "n", 2.0)]
    scored = spark.createDataFrame(rows, "s string, day int, y double, model string, yhat double")
    got = rmse_by_model(on_common_rows(scored, ["s", "day"], ["m", "n"], "y", "yhat"), "y", "yhat")
    assert {r.model: r.n for r in got.collect()} == {"m": 4, "n": 4}


def test_null_series_keys_and_short_series(spark):
    df = _series(spark, lambda k, t: 2.0 + 0.1 * t, range(1, 60), keys=(None,))
    short = _series(spark, lambda k, t: float(t), range(1, 4), keys=("short",))
    for rows in (df, df.unionByName(short)):
        for est in (TrendWeekdayForecaster(labelCol="y", groupCols=["s"]), FourierForecaster(labelCol="y", groupCols=["s"])):
            scored = est.fit(rows).transform(rows)
            assert scored.where("yhat is null").count() == 0 and scored.count() == rows.count()
    coef = FourierForecaster(labelCol="y", groupCols=["s"]).fit(short).coefficients.first().coef
    assert not any(coef[2:]) and abs(coef[1]) > 0
    with pytest.raises(ValueError):
        TrendWeekdayForecaster(labelCol="y").fit(df)


def test_scoring_twice_fits_once(spark, monkeypatch):
    from tidecast.models import series

    df = _series(spark, lambda k, t: t + 1.0, range(1, 40))
    model = FourierForecaster(labelCol="y", groupCols=["s"]).fit(df)
    monkeypatch.setattr(series, "_ridge_solver", None)
    assert model.transform(df).count() == model.transform(df).count() == 39
    plan = model.coefficients._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan and "parquet" in plan.lower()


def test_tuning_saves_model_and_trials(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressionModel

    rows = spark.createDataFrame([(float(x), 2.0 * x) for x in range(60)], "x double, LogSales double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    result = tune(spark, df, df, grid={"maxDepth": [2], "maxIter": [3]})
    result.save(str(tmp_path / "tuned"))
    loaded = GBTRegressionModel.load(str(tmp_path / "tuned" / "model"))
    assert abs(rmse_of(loaded, df) - result.best_loss) < 1e-9
    assert spark.read.parquet(str(tmp_path / "tuned" / "trials")).count() == 1
