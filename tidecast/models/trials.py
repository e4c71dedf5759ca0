"""A trial table that outlives the run, and a search that drops weak points.

Each finished trial is appended as one Parquet row under a key of its family,
parameters, budget, seed and data, its model beside it; a search that starts
again skips what is finished and tries failed points anew. Choices are a query
over the table: the lowest loss of the trials that are ``ok``.

``halving`` spends the budget (number of trees) in rungs: all points get the
smallest budget, the better half goes on to the next one. Losses come from a
validation part, never from the test rows.

Defined results: a NaN or missing loss is a failed trial; equal losses go to
the smaller budget, then the smaller key; a table without an ``ok`` trial has no
choice; concurrent appends do no harm, and a key finished twice counts once.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import logging
import math
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.models.trees import gbt, rmse_of

log = logging.getLogger(__name__)

SCHEMA = ("trial_key string, data_key string, family string, params map<string,string>, budget int, loss double, "
          "status string")


def trial_key(data_key: str, family: str, params: dict, budget: int, seed: int) -> str:
    """The same for equal trials in any run: 32 hexadecimal digits."""
    text = json.dumps([data_key, family, sorted((k, str(v)) for k, v in params.items()), budget, seed])
    return hashlib.sha256(text.encode()).hexdigest()[:32]


class TrialLog:
    """Trials below one shared folder: ``trials`` (Parquet, appended) and
    ``models/<key>``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        """One row for each key: a finished one if there is any."""
        try:
            found = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{self.path}/trials")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)
        row = F.struct((F.col("status") != "ok").alias("failed"), "loss", *[c for c in found.columns if c not in (
            "trial_key", "loss", "params")], F.to_json("params").alias("json"))
        return found.groupBy("trial_key").agg(F.min(row).alias("r")).select(
            "trial_key", "r.data_key", "r.family", F.from_json("r.json", "map<string,string>").alias("params"),
            "r.budget", "r.loss", "r.status")

    def finished(self, data_key: str) -> dict[str, float]:
        done = self.rows().where((F.col("data_key") == data_key) & (F.col("status") == "ok"))
        return {r["trial_key"]: r["loss"] for r in done.select("trial_key", "loss").collect()}

    def append(self, rows: DataFrame | Sequence[tuple]) -> None:
        table = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame(rows, SCHEMA)
        # A folder for each append: jobs that end at the same time do not
        # clear each other's unfinished files away.
        table.write.parquet(f"{self.path}/trials/{uuid.uuid4().hex}")

    def best(self, by: Sequence[str] = ("data_key",)) -> DataFrame:
        """The chosen trial of each group."""
        good = self.rows().where((F.col("status") == "ok") & F.col("loss").isNotNull() & ~F.isnan("loss"))
        row = F.struct("trial_key", *[c for c in ("family", "params", "budget", "loss") if c not in by])
        chosen = good.groupBy(*by).agg(F.min_by(row, F.struct("loss", "budget", "trial_key")).alias("t"))
        return chosen.select(*by, "t.*")

    def model_path(self, key: str) -> str:
        return f"{self.path}/models/{key}"

    def best_model(self, data_key: str) -> GBTRegressionModel | None:
        """The model of the chosen trial, loaded from beside the table."""
        row = self.best().where(F.col("data_key") == data_key).first()
        return GBTRegressionModel.load(self.model_path(row["trial_key"])) if row else None


def run_missing(trials: TrialLog, data_key: str, family: str, points: Sequence[dict], budget: int,
                fit: Callable[[dict, int], tuple], seed: int = 42, parallelism: int = 2) -> dict[int, float]:
    """Losses of ``points`` (by place) at ``budget``; those in the table are
    not fitted again. ``fit`` returns (model, loss)."""
    done = trials.finished(data_key)
    keys = [trial_key(data_key, family, p, budget, seed) for p in points]

    def one(i: int) -> float | None:
        if keys[i] in done:
            return done[keys[i]]
        loss, status = None, "fail"
        try:
            model, loss = fit(points[i], budget)
            if loss is not None and not math.isnan(loss):
                status = "ok"
                if hasattr(model, "write"):
                    model.write().overwrite().save(trials.model_path(keys[i]))
        except Exception as exc:  # recorded, not fatal
            log.warning("trial %s failed: %s", points[i], exc)
        params = {k: str(v) for k, v in points[i].items()}
        trials.append([(keys[i], data_key, family, params, budget, loss, status)])
        return loss if status == "ok" else None

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        losses = list(pool.map(one, range(len(points))))
    return {i: x for i, x in enumerate(losses) if x is not None}


def halving(trials: TrialLog, data_key: str, train: DataFrame, validation: DataFrame, grid: dict[str, list],
            budgets: Sequence[int], seed: int = 42, parallelism: int = 2) -> DataFrame:
    """Boosted trees over ``grid`` (without the number of trees, which is the
    budget). Returns the trials of ``data_key``; the choice is ``trials.best``."""
    names = list(grid)
    points = [dict(zip(names, values)) for values in itertools.product(*grid.values())]

    def fit(params: dict, budget: int) -> tuple:
        est = gbt(max_iter=budget, seed=seed)
        model = est.fit(train, {est.getParam(k): v for k, v in params.items()})
        return model, rmse_of(model, validation)

    for budget in sorted(budgets):
        losses = run_missing(trials, data_key, "trees", points, budget, fit, seed, parallelism)
        order = sorted(losses, key=lambda i: (losses[i], i))
        points = [points[i] for i in order[:max(1, math.ceil(len(order) / 2))]]
        if not points:
            break
    return trials.rows().where(F.col("data_key") == data_key)
