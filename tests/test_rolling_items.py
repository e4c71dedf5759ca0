"""Rolling origins, item forecasts, ranks and labels against plain versions."""

import datetime
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidecast.models.rolling import backtest, backtest_rmse
from tidecast.models.selection import join_pred_actual
from tidecast.operators.labels import LabelIndexer, LabelIndexerModel, label_table
from tidecast.operators.split import distributed_percent_rank, time_percent_rank
from tidecast.plans.items import Axis, item_forecasts, reconcile

START = datetime.date(2000, 1, 1)


def day(d):
    return START + datetime.timedelta(days=d)


def test_backtest_equals_fits_on_all_earlier_rows(spark):
    rng, rows = random.Random(7), []
    for s in ("a", None):
        rows += [(s, d, day(d), 0.01 * d + (d % 7) / 5 + rng.gauss(0, 0.1)) for d in range(200) if rng.random() < 0.8]
    rows += [("once", 10, day(10), 1.0), ("once", 190, day(190), 2.0), ("late", 150, day(150), 1.0), ("a", 500, day(500), None)]
    cuts = [99, 139, 179]
    got = backtest(spark.createDataFrame(rows, "s string, day int, date date, y double"), ["s"], "day", "date", "y",
                   [day(c).isoformat() for c in cuts]).collect()
    by = defaultdict(dict)
    for r in got:
        by[r["s"], r["fold"], r["t"]][r["model"]] = r["yhat"]
    for s, d, when, y in rows:
        fold = sum(c < d for c in cuts)
        past = [x for x in rows if x[0] == s and x[3] is not None and fold and x[1] <= cuts[fold - 1]]
        if not fold or y is None or not past:
            assert (s, fold, float(d)) not in by
            continue
        mine = by[s, fold, float(d)]
        assert mine["level"] == pytest.approx(sum(x[3] for x in past) / len(past))
        if len({x[1] for x in past}) < 2:
            assert mine["trend"] is None
            continue
        slope, start = np.polyfit([x[1] for x in past], [x[3] for x in past], 1)
        same = [x[3] - start - slope * x[1] for x in past if x[2].weekday() == when.weekday()]
        assert mine["trend"] == pytest.approx(start + slope * d, abs=1e-6)
        assert mine["trend_weekday"] == pytest.approx(start + slope * d + (sum(same) / len(same) if same else 0), abs=1e-6)
    scores = {(r["fold"], r["model"]): r for r in backtest_rmse(spark.createDataFrame(got)).collect()}
    assert scores[1, "trend_weekday"]["rmse"] < scores[1, "trend"]["rmse"] < scores[1, "level"]["rmse"]
    assert scores[3, "level"]["n"] == scores[3, "trend"]["n"] + 1  # "once" has no line
    assert set(k for k, _ in scores) == {1, 2, 3}


def sales(spark, rows):
    return spark.createDataFrame([(a, b, c, d, day(d), y) for a, b, c, d, y in rows],
                                 "store_id string, dept_id string, item_id string, day int, date date, sales double")


def test_item_lines_count_days_without_sales(spark):
    rng = random.Random(2)
    rows = [("s", "d", i, d, float(rng.randrange(1, 9))) for i in ("a", "b", None) for d in range(3, 61) if rng.random() < 0.3]
    rows += [("s", "d", "once", 20, 6.0), (None, "d", "x", 30, 4.0), ("s", "d", "late", 70, 99.0)]
    items, depts = item_forecasts(sales(spark, rows), 60, 14)
    items, depts = items.collect(), depts.collect()
    first = min(d for *_, d, _ in rows)
    axis = np.arange(first, 61)
    sold = defaultdict(lambda: np.zeros(len(axis)))
    for a, b, c, d, y in rows:
        if d <= 60:
            sold[a, b, c][d - first] += y
    assert {(r["store_id"], r["dept_id"], r["item_id"]) for r in items} == set(sold)
    for r in items:
        slope, start = np.polyfit(axis, sold[r["store_id"], r["dept_id"], r["item_id"]], 1)
        assert r["yhat"] == pytest.approx(start + slope * r["day"], abs=1e-8)
    total = defaultdict(float)
    for r in items:
        total[r["store_id"], r["day"]] += r["reconciled"]
    assert len(depts) == 2 * 14 and {r["day"] for r in depts} == set(range(61, 75))
    for r in depts:
        assert total[r["store_id"], r["day"]] == pytest.approx(r["reconciled"], abs=1e-8)
        y = sum(v for (s, _, _), v in sold.items() if s == r["store_id"])
        slope, start = np.polyfit(axis, y, 1)
        left = (y - start - slope * axis)[axis % 7 == r["day"] % 7]
        assert r["yhat"] == pytest.approx(start + slope * r["day"] + left.mean(), abs=1e-8)


def test_reconciled_is_the_weighted_least_squares_point(spark):
    items = spark.createDataFrame([(None, "a", 1.0, 0.5), (None, "b", 2.0, 1.5), ("z", "c", 1.0, 0.0)],
                                  "g string, i string, yhat double, weight double")
    depts = spark.createDataFrame([(None, 5.0, 2.0), ("z", 4.0, 0.0)], "g string, yhat double, weight double")
    got, whole = reconcile(items, depts, ["g"])
    got = {r["i"]: r["reconciled"] for r in got.collect()}
    # Minimum of sum (x - base)^2 / weight where the items add up: by Lagrange.
    s = np.array([[1.0, 0], [0, 1], [1, 1]])
    w = np.diag(1 / np.array([0.5, 1.5, 2.0]))
    want = np.linalg.solve(s.T @ w @ s, s.T @ w @ np.array([1.0, 2.0, 5.0]))
    assert [got["a"], got["b"]] == pytest.approx(want.tolist())
    assert {r["g"]: r["reconciled"] for r in whole.collect()} == pytest.approx({None: want.sum(), "z": 4.0})
    assert got["c"] == 4.0


def test_axis_sums():
    for a, b in ((1, 1), (3, 50), (-4, 9), (0, 5)):
        days = list(range(a, b + 1))
        x = Axis(a, b)
        assert (x.n, x.st, x.stt) == (len(days), sum(days), sum(d * d for d in days))


def test_no_sales_before_the_cutoff(spark):
    items, depts = item_forecasts(sales(spark, [("s", "d", "a", 70, 1.0)]), 60, 3)
    assert items.count() == depts.count() == 0


def test_distributed_rank_equals_percent_rank(spark):
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, rng.choice([None, *range(40)])) for i in range(300)], "i int, t int")
    plain = time_percent_rank(rows, "t", "rank")
    for parts in (1, 3, 64):
        got = distributed_percent_rank(rows, "t", "rank", parts)
        assert sorted((r["i"], round(r["rank"], 12)) for r in got.collect()) == sorted(
            (r["i"], round(r["rank"], 12)) for r in plain.collect())
    assert distributed_percent_rank(rows.limit(1), "t").first()["rank"] == 0.0
    assert distributed_percent_rank(rows.where("false"), "t").count() == 0


def test_distributed_rank_has_no_single_partition(spark):
    rows = spark.range(1000).withColumn("t", F.col("id") % 700)
    plan = distributed_percent_rank(rows, "t")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_labels_equal_string_indexer(spark, tmp_path):
    rng = random.Random(4)
    rows = spark.createDataFrame([(rng.choice(["a", "b", "c", "dd", "é", "", None]),) for _ in range(200)]
                                 + [("x",), ("y",), ("z",)], "v string")
    want = StringIndexer(inputCol="v", outputCol="i", handleInvalid="keep").fit(rows).transform(rows)
    model = LabelIndexer(inputCol="v", outputCol="i").fit(rows)
    model.save(f"{tmp_path}/m")
    for m in (model, LabelIndexerModel.load(f"{tmp_path}/m")):
        assert sorted(map(str, m.transform(rows).collect())) == sorted(map(str, want.collect()))
        unseen = spark.createDataFrame([("new",), (None,)], "v string")
        assert {r["i"] for r in m.transform(unseen).collect()} == {float(model.n_labels)}
    for parts in (1, 50):
        assert [r["index"] for r in label_table(rows, "v", parts).orderBy("index").collect()] == [
            float(i) for i in range(model.n_labels)]
    empty = LabelIndexer(inputCol="v", outputCol="i").fit(rows.where("false"))
    assert empty.transform(rows.where("v IS NULL")).first()["i"] == 0.0


def test_numbers_are_indexed_as_text(spark):
    rows = spark.createDataFrame([(10,), (9,), (9,), (2,)], "v int")
    got = {r["v"]: r["i"] for r in LabelIndexer(inputCol="v", outputCol="i").fit(rows).transform(rows).collect()}
    assert got == {9: 0.0, 10: 1.0, 2: 2.0}


def test_null_keys_meet_their_predictions(spark):
    actual = spark.createDataFrame([(None, 1, 2.0), ("a", 1, 3.0)], "s string, day int, y double")
    told = spark.createDataFrame([(None, 1, 2.5)], "s string, day int, yhat double")
    got = {r["s"]: r["yhat"] for r in join_pred_actual(actual, told, ["s", "day"]).collect()}
    assert got == {None: 2.5, "a": None} and not math.isnan(got[None])
