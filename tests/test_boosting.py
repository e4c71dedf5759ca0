"""Histogram boosting against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidecast.models.boosting import (HistGBTModel, HistGBTRegressor, best_splits, bin_edges, histogram, split_gains,
                                      with_bins)

NAN = float("nan")


def made(n=400, seed=4):
    """The label depends on x0 at 3, on whether x1 is there, and not on x2."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        x = [rng.randrange(1, 8) * 1.0, rng.choice([0.0, None, NAN, 2.0, 5.0]), rng.choice([1.0, 2.0])]
        there = x[1] not in (0.0, None) and not math.isnan(x[1])
        rows.append((x, (4.0 if x[0] > 3 else 0.0) + (0.0 if there else 2.5) + rng.gauss(0, 0.1)))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([*made(), ([1.0, 2.0, 1.0], None)], "features array<double>, LogSales double").cache()


def missing(x):
    return x is None or math.isnan(x) or x == 0.0


def plain_gain(data, feature, threshold, side, reg):
    mean = sum(y for _, y in data) / len(data)
    left = [y - mean for x, y in data if (side if missing(x[feature]) else x[feature] <= threshold)]
    right = [y - mean for x, y in data if not (side if missing(x[feature]) else x[feature] <= threshold)]
    total = left + right
    return sum(sum(p) ** 2 / (len(p) + reg) for p in (left, right)) - sum(total) ** 2 / (len(total) + reg)


def test_gains_are_those_of_a_plain_count(spark, rows):
    data = made()
    labelled = rows.where("LogSales IS NOT NULL")
    edges = bin_edges(labelled, F.col("features"), 3, 16, 0.0)
    assert [x in edges[0] for x in (1.0, 2.0, 3.0, 6.0)] == [True] * 4 and edges[1] == [2.0] and edges[2] == [1.0]
    mean = sum(y for _, y in data) / len(data)
    binned = with_bins(labelled, F.col("features"), edges, 0.0, F.lit(0).alias("node"),
                       (F.col("LogSales") - mean).alias("g"))
    gains = split_gains(histogram(binned, 3), 1.0)
    got = {(r["feature"], r["bin"], r["missing_left"]): r["gain"] for r in gains.collect()}
    for (f, b, side), gain in got.items():
        threshold = edges[f][b - 1] if b <= len(edges[f]) else math.inf
        assert gain == pytest.approx(plain_gain(data, f, threshold, side, 1.0), abs=1e-6)
    best = best_splits(gains).first()
    assert (best["feature"], edges[0][best["bin"] - 1]) == (0, 3.0)
    assert best["gain"] == max(got.values())


def test_missing_direction_is_learnt(rows):
    model = HistGBTRegressor(maxDepth=2, maxIter=5, stepSize=0.9).fit(rows)
    scored = model.transform(rows.where("LogSales IS NOT NULL"))
    assert scored.agg(F.sqrt(F.avg((F.col("LogSales") - F.col("prediction")) ** 2))).first()[0] < 0.2
    splits = [n.split for t in model.trees for n in t if n.split]
    assert any(s.feature == 1 and math.isinf(s.threshold) for s in splits)  # there or not
    none = HistGBTRegressor(maxDepth=1, maxIter=1, missing=NAN).fit(rows)  # then 0.0 is a value like 2.0
    assert none.trees[0][0].split.feature == 0 and math.isnan(none.missing_value)


def test_predictions_follow_the_trees(spark, rows):
    model = HistGBTRegressor(maxDepth=2, maxIter=3).fit(rows)

    def predict(x):
        out = model.base
        for nodes in model.trees:
            node = nodes[0]
            while node.split:
                s = node.split
                left = s.missing_left if missing(x[s.feature]) else x[s.feature] <= s.threshold
                node = nodes[node.left if left else node.right]
            out += node.value
        return out

    cases = [([a, b, 1.0], predict([a, b, 1.0])) for a in (0.0, 1.0, 3.0, 3.5, 9.0) for b in (0.0, 2.0, 7.0)]
    got = model.transform(spark.createDataFrame(cases, "features array<double>, want double")).collect()
    assert all(r["prediction"] == pytest.approx(r["want"], abs=1e-12) for r in got)
    one = model.first(1).transform(spark.createDataFrame(cases, "features array<double>, want double"))
    assert len(model.first(1).trees) == 1 and one.count() == 15


def test_saved_model_predicts_the_same(rows, tmp_path):
    model = HistGBTRegressor(maxDepth=2, maxIter=2).fit(rows)
    model.save(f"{tmp_path}/m")
    back = HistGBTModel.load(f"{tmp_path}/m")
    a, b = (sorted(r["prediction"] for r in m.transform(rows).collect()) for m in (model, back))
    assert a == b and back.getPredictionCol() == "prediction"


def test_empty_and_constant_input(spark, rows):
    assert HistGBTRegressor().fit(rows.where("false")).transform(rows).first()["prediction"] is None
    flat = spark.createDataFrame([([None, 1.0], 2.0), ([None, 1.0], 2.0)], "features array<double>, LogSales double")
    model = HistGBTRegressor(maxIter=2).fit(flat)
    assert [len(t) for t in model.trees] == [1, 1] and model.transform(flat).first()["prediction"] == pytest.approx(2.0)
