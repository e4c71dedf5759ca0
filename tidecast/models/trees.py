"""Gradient-boosted regression trees and a grid search over them.

Every grid point is fitted on the same chronological train set and scored
by RMSE on the later test set. Train and test should be materialised
(checkpointed) once by the caller: each fit then starts from the written
table instead of re-running the feature plan. Grid points are fitted
concurrently from a small driver thread pool (as ``TrainValidationSplit``
does with its ``parallelism``); Spark schedules their jobs side by side.
"""

from __future__ import annotations

import itertools
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, IntegerType, MapType, StringType, StructField, StructType

log = logging.getLogger(__name__)

TRIALS_SCHEMA = StructType([
    StructField("trial_id", IntegerType(), False),
    StructField("family", StringType(), False),
    StructField("params", MapType(StringType(), StringType()), False),
    StructField("loss", DoubleType(), True),
    StructField("status", StringType(), False),
])

# Grid searched by default: tree depth x number of trees.
DEFAULT_GRID = {"maxDepth": [2, 5], "maxIter": [10, 100]}


def gbt(label_col: str = "LogSales", features_col: str = "features", prediction_col: str = "prediction",
        max_depth: int = 2, max_iter: int = 10, seed: int = 42) -> GBTRegressor:
    """Squared-error boosting. Zeros are ordinary values (no missing-value
    mode), so one-hot and flag zeros keep their meaning."""
    return GBTRegressor(labelCol=label_col, featuresCol=features_col, predictionCol=prediction_col,
                        maxDepth=max_depth, maxIter=max_iter, seed=seed, lossType="squared")


def rmse_of(model, test: DataFrame, label_col: str = "LogSales") -> float:
    evaluator = RegressionEvaluator(metricName="rmse", labelCol=label_col,
                                    predictionCol=model.getPredictionCol())
    return float(evaluator.evaluate(model.transform(test)))


@dataclass
class TuningResult:
    trials: DataFrame
    best_model: GBTRegressionModel | None
    best_loss: float | None
    best_params: dict

    def save(self, path: str) -> None:
        """Write the trial table and, where a trial succeeded, its model."""
        self.trials.write.parquet(f"{path}/trials")
        if self.best_model is not None:
            self.best_model.write().save(f"{path}/model")


def tune(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    grid: dict[str, list] | None = None,
    label_col: str = "LogSales",
    features_col: str = "features",
    seed: int = 42,
    parallelism: int = 2,
) -> TuningResult:
    """Exhaustive search over ``grid``; returns the trial table and the best
    model (lowest test RMSE, first point on ties)."""
    grid = grid or DEFAULT_GRID
    names = list(grid)
    points = [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]
    est = gbt(label_col, features_col, seed=seed)
    param_maps = [{est.getParam(k): v for k, v in p.items()} for p in points]

    models: dict[int, GBTRegressionModel] = {}
    losses: dict[int, float | None] = {}
    status: dict[int, str] = {}

    def run(index: int):
        try:
            model = est.copy(param_maps[index]).fit(train)
            return index, model, rmse_of(model, test, label_col), "ok"
        except Exception as exc:  # a failed trial is recorded, not fatal
            log.warning("trial %d failed: %s", index, exc)
            return index, None, None, "fail"

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for index, model, loss, st in pool.map(run, range(len(points))):
            models[index], losses[index], status[index] = model, loss, st

    rows = [(i, "trees", {k: str(v) for k, v in points[i].items()}, losses[i], status[i])
            for i in range(len(points))]
    trials = spark.createDataFrame(rows, TRIALS_SCHEMA)
    ok = [i for i in range(len(points)) if status[i] == "ok" and losses[i] == losses[i]]  # NaN: failed
    if not ok:
        return TuningResult(trials, None, None, {})
    best = min(ok, key=lambda i: (losses[i], i))
    return TuningResult(trials, models[best], losses[best], points[best])
