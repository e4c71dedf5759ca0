"""Forecasts with change points: planted breaks, the descent, saving."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidecast.functions.metrics import rmse
from tidecast.models.changepoints import ChangePointForecaster, basis, basis_np, descend
from tidecast.models.series import FourierForecaster, N_TERMS

BREAKS = {None: [], "one": [400], "two": [300, 700]}


def value(name, day, rng):
    slope, y, last = 0.004, 3.0, 0
    for k, b in enumerate([*BREAKS[name], 10**9]):
        y += slope * (min(day, b) - last)
        if day <= b:
            break
        last, slope = b, -0.006 if k % 2 == 0 else 0.008
    return y + 0.3 * math.sin(2 * math.pi * day / 7) + rng.gauss(0, 0.05)


@pytest.fixture(scope="module")
def rows(spark):
    rng, start = random.Random(5), datetime.date(2000, 1, 1)
    data = [(name, d, start + datetime.timedelta(days=d), value(name, d, rng)) for name in BREAKS for d in range(1, 1201)]
    data += [("short", 1, start, 1.0), ("short", 2, start, 2.0), ("single", 1, start, 1.0), ("none", 5, start, None)]
    return spark.createDataFrame(data, "name string, day int, date date, LogSales double").cache()


@pytest.fixture(scope="module")
def model(rows):
    return ChangePointForecaster(groupCols=["name"], changePoints=12, changeRange=0.96).fit(rows.where("day <= 1000"))


def test_planted_breaks_are_found(model):
    got = {}
    for r in model.changes().collect():
        got.setdefault(r["name"], []).append((r["day"], r["change"]))
    for name, days in BREAKS.items():
        strong = [d for d, c in got.get(name, []) if abs(c) > 0.6]  # planted: 3.65 and more a year
        assert len(strong) >= len(days)
        for d in strong:
            assert any(abs(d - b) <= 85 for b in days), (name, got.get(name))
        for b in days:
            total = sum(c for d, c in got[name] if abs(d - b) <= 170)
            assert abs(total) > 2.0


def test_better_than_a_straight_line(rows, model):
    after = rows.where("day > 1000")
    straight = FourierForecaster(groupCols=["name"]).fit(rows.where("day <= 1000"))
    loss = {}
    for name, m in (("bent", model), ("straight", straight)):
        for r in m.transform(after).groupBy("name").agg(rmse("LogSales", "yhat").alias("loss")).collect():
            loss[name, r["name"]] = r["loss"]
    for name in ("one", "two"):
        assert loss["bent", name] < 0.7 * loss["straight", name]
    assert loss["bent", None] < 0.3


def test_short_series_and_null_keys(model, rows):
    coef = {r["name"]: r["coef"] for r in model.coefficients.collect()}
    assert coef["single"] is None and "none" not in coef and None in coef
    assert all(c == 0 for c in coef["short"][N_TERMS:])
    assert model.transform(rows.where("name IS NULL AND day = 1100")).first()["yhat"] is not None


def test_descent_is_the_minimum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 9))
    y = x @ np.array([1, 2, 0, 0, 3, 0, 0, 0.1, 0]) + rng.normal(size=200)
    gram, rhs = x.T @ x, x.T @ y
    l1 = np.array([0.0, 0, 0, *[30.0] * 6])
    ridge = np.full(9, 0.5)
    c = descend(gram, rhs, l1, ridge, np.ones(9, bool))

    def loss(c):
        return c @ gram @ c / 2 - rhs @ c + l1 @ np.abs(c) + ridge @ (c * c) / 2

    best = loss(c)
    assert (c[3:] == 0).any() and c[4] != 0
    for _ in range(300):
        assert loss(c + rng.normal(size=9) * 10.0 ** rng.integers(-4, 1)) >= best - 1e-9


def test_basis_is_the_same_on_both_sides(spark):
    points = [10.0, 55.0, 400.0]
    days = spark.createDataFrame([(d,) for d in (1, 10, 54, 56, 1000)], "day int")
    got = days.select("day", F.array(*basis(F.col("day"), 700.0, points)).alias("x")).orderBy("day").collect()
    want = basis_np(np.array([r["day"] for r in got]), 700.0, np.array(points))
    assert np.allclose([r["x"] for r in got], want)


def test_pipeline_with_a_forecaster_saves(rows, model, tmp_path):
    fitted = Pipeline(stages=[ChangePointForecaster(groupCols=["name"], changePoints=5)]).fit(rows.where("day <= 900"))
    fitted.write().save(f"{tmp_path}/p")
    back = PipelineModel.load(f"{tmp_path}/p")
    after = rows.where("day > 900")
    a, b = (sorted((str(r["name"]), r["day"], r["yhat"]) for r in m.transform(after).collect()) for m in (fitted, back))
    assert a == b
    with pytest.raises(Exception):
        fitted.write().save(f"{tmp_path}/p")  # nothing is overwritten in silence
    fitted.write().overwrite().save(f"{tmp_path}/p")


def test_empty_input(spark, rows):
    model = ChangePointForecaster(groupCols=["name"]).fit(rows.where("false"))
    assert model.coefficients.count() == 0 and model.points == []
    assert model.transform(rows.limit(1)).first()["yhat"] is None
