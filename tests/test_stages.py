import datetime
import math

from pyspark.ml import Pipeline, PipelineModel

from tidecast.operators.stages import (
    DailySum,
    LagFeatures,
    LogTransformer,
    MeanImputer,
    MeanImputerModel,
    NullProfiler,
    ZeroReplacer,
    null_profile,
)


def test_replace_zero_subset_only(spark):
    df = spark.createDataFrame([(0.0, 0), (1.5, 0), (None, 1)], "x double, k int")
    rows = ZeroReplacer(inputCols=["x"]).transform(df).collect()
    assert [r.x for r in rows] == [0.5, 1.5, None]
    assert [r.k for r in rows] == [0, 0, 1]


def test_replace_zero_int_column_keeps_zero(spark):
    df = spark.createDataFrame([(0,)], "k int")
    out = ZeroReplacer(inputCols=["k"]).transform(df)
    assert out.schema["k"].dataType.simpleString() == "int"
    assert out.first().k == 0


def test_log_transformer(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "x double")
    got = [r.y for r in LogTransformer(inputCol="x", outputCol="y").transform(df).collect()]
    assert got == [0.0, None, None, None]


def test_lag_counts_rows_not_days_and_stays_in_series(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 2, 20.0), ("a", 5, 50.0), ("b", 1, 1.0), ("b", 2, 2.0)],
        "s string, day int, v double")
    lf = LagFeatures(inputCol="v", outputCol="L", numLags=2, timeCol="day", partitionCols=["s"])
    rows = {(r.s, r.day): (r.L1, r.L2) for r in lf.transform(df).collect()}
    assert rows[("a", 1)] == (None, None)
    assert rows[("a", 2)] == (10.0, None)
    assert rows[("a", 5)] == (20.0, 10.0)
    assert rows[("b", 1)] == (None, None)
    assert rows[("b", 2)] == (1.0, None)


def test_lag_i_equals_lag1_applied_i_times(spark):
    data = [("s", d, float(d * d % 7)) for d in range(1, 30)]
    df = spark.createDataFrame(data, "s string, day int, v double")
    lags = LagFeatures(inputCol="v", outputCol="L", numLags=3, timeCol="day", partitionCols=["s"]).transform(df)
    once = LagFeatures(inputCol="v", outputCol="A", numLags=1, timeCol="day", partitionCols=["s"])
    twice = LagFeatures(inputCol="A1", outputCol="B", numLags=1, timeCol="day", partitionCols=["s"])
    thrice = LagFeatures(inputCol="B1", outputCol="C", numLags=1, timeCol="day", partitionCols=["s"])
    chained = thrice.transform(twice.transform(once.transform(df)))
    a = {r.day: r.L3 for r in lags.collect()}
    b = {r.day: r.C1 for r in chained.collect()}
    assert a == b


def test_mean_imputer(spark):
    df = spark.createDataFrame([(1.0, None, 1), (None, None, None), (3.0, None, 2)],
                               "x double, empty double, k int")
    model = MeanImputer(inputCols=["x", "empty", "k"]).fit(df)
    assert model.unfilledColumns() == ["empty"]
    out = model.transform(df).collect()
    assert [r.x for r in out] == [1.0, 2.0, 3.0]
    assert [r.empty for r in out] == [None, None, None]
    assert [r.k for r in out] == [1.0, 1.5, 2.0]  # cast to double, not truncated


def test_mean_imputer_fit_on_train_only(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    test = spark.createDataFrame([(None,), (100.0,)], "x double")
    model = MeanImputer(inputCols=["x"]).fit(train)
    assert [r.x for r in model.transform(test).collect()] == [2.0, 100.0]


def test_null_profile_type_aware(spark):
    df = spark.createDataFrame(
        [(float("nan"), None, None, "a"), (1.0, "x", datetime.date(2020, 1, 1), None)],
        "d double, s string, dt date, t string")
    row = null_profile(df).first()
    assert (row.d, row.s, row.dt, row.t) == (1, 1, 1, 1)
    assert NullProfiler().transform(df).count() == 1


def test_daily_sum_null_key_is_one_group(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 2.0), ("a", "x", 4.0)],
                               "k string, ev string, v double")
    out = DailySum(inputCol="v", outputCol="s", groupCols=["k", "ev"]).transform(df)
    got = {r.ev: r.s for r in out.collect()}
    assert got == {None: 3.0, "x": 4.0}


def test_stage_save_load_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 2.0), ("a", 3, None)], "s string, day int, v double")
    pipe = Pipeline(stages=[
        ZeroReplacer(inputCols=["v"], value=0.25),
        LogTransformer(inputCol="v", outputCol="lv"),
        LagFeatures(inputCol="lv", outputCol="L", numLags=2, timeCol="day", partitionCols=["s"]),
        MeanImputer(inputCols=["L1", "L2"]),
    ])
    model = pipe.fit(df)
    path = str(tmp_path / "pipe")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = sorted(map(tuple, model.transform(df).collect()), key=repr)
    b = sorted(map(tuple, loaded.transform(df).collect()), key=repr)
    assert a == b
    imp = [s for s in loaded.stages if isinstance(s, MeanImputerModel)][0]
    assert not any(math.isnan(v) for v in imp.getOrDefault(imp.fillValues))
    stage = DailySum(inputCol="v", outputCol="s", groupCols=["s"])
    stage.write().overwrite().save(str(tmp_path / "ds"))
    assert DailySum.load(str(tmp_path / "ds")).getGroupCols() == ["s"]
