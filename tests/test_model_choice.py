"""The whole run at a date cutoff, its kept model, and common rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tidecast.models.selection import load_model, on_common_rows, save_model
from tidecast.models.series import TrendWeekdayForecaster
from tidecast.plans import catalog as cat
from tidecast.plans import features as fe


def test_chosen_model_is_kept(spark):
    rows = entry_mod.queries()["cutoff_model_choice"](spark, SF_SMALL).collect()
    chosen = [r for r in rows if r["chosen"]]
    assert len(rows) == 3 and len(chosen) == 1 and len({r["n"] for r in rows}) == 1
    assert chosen[0]["reloaded"] == pytest.approx(chosen[0]["rmse"], abs=1e-9)
    assert all(r["reloaded"] is None for r in rows if not r["chosen"])


def test_cutoff_features_know_nothing_of_later_rows(spark):
    daily = fe.materialize(fe.daily_sales(spark, SF_SMALL))
    whole = fe.feature_set(daily, cutoff=cat.FORECAST_CUTOFF)
    early = fe.feature_set(fe.materialize(daily.where(F.col("date") <= F.lit(cat.FORECAST_CUTOFF).cast("date"))), 1.0)
    a = whole.assembled.where("_rank IS NOT NULL")
    assert sorted(map(str, a.collect())) == sorted(map(str, early.assembled.collect()))
    assert whole.assembled.where("_rank IS NULL").agg(F.min("date")).first()[0].isoformat() > cat.FORECAST_CUTOFF
    with pytest.raises(ValueError):
        fe.feature_set(daily, 0.8, cat.FORECAST_CUTOFF)


def test_common_rows_need_every_model(spark):
    rows = [("a", 1, "m", 1.0, 2.0), ("a", 1, "n", 1.0, 3.0), ("a", 2, "m", 1.0, 2.0), ("a", 2, "n", 1.0, None),
            (None, 3, "m", 1.0, 2.0), (None, 3, "n", 1.0, 2.0), ("a", 4, "m", None, 2.0), ("a", 4, "n", None, 2.0),
            ("a", 5, "m", 1.0, float("nan")), ("a", 5, "n", 1.0, 1.0), ("a", 6, "m", 1.0, 1.0), ("a", 6, "other", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "s string, day int, model string, y double, yhat double")
    got = on_common_rows(df, ["s", "day"], ["m", "n"], "y", "yhat")
    assert got.columns == df.columns
    assert sorted((str(r["s"]), r["day"], r["model"]) for r in got.collect()) == [
        ("None", 3, "m"), ("None", 3, "n"), ("a", 1, "m"), ("a", 1, "n")]


def test_kept_model_is_not_replaced_in_silence(spark, tmp_path):
    df = spark.createDataFrame([("a", d, 1.0 * d) for d in range(20)], "s string, day int, LogSales double") \
        .withColumn("date", F.date_add(F.lit("2000-01-01").cast("date"), F.col("day")))
    model = TrendWeekdayForecaster(groupCols=["s"]).fit(df)
    save_model(model, f"{tmp_path}/m")
    with pytest.raises(Exception):
        save_model(model, f"{tmp_path}/m")
    a, b = (sorted((r["day"], r["yhat"]) for r in m.transform(df).collect()) for m in (model, load_model(spark, f"{tmp_path}/m")))
    assert a == b
