"""Trial tables: resumed searches, halving and choices."""

import pytest
from pyspark.ml.linalg import Vectors

from tidecast.models.trees import rmse_of, tune
from tidecast.models.trials import TrialLog, halving, run_missing, trial_key


class Fits:
    """Losses by parameters; counts what is fitted."""

    def __init__(self, losses):
        self.losses, self.calls = losses, []

    def __call__(self, params, budget):
        self.calls.append((params["p"], budget))
        loss = self.losses[params["p"]]
        if loss == "broken":
            raise RuntimeError("no luck")
        return None, loss


def test_finished_trials_are_not_fitted_again(spark, tmp_path):
    log = TrialLog(spark, str(tmp_path))
    assert log.rows().count() == 0 and log.best().count() == 0
    fits = Fits({1: 0.5, 2: "broken", 3: float("nan"), 4: 0.25, 5: 0.25})
    points = [{"p": i} for i in range(1, 6)]
    assert run_missing(log, "d", "f", points, 10, fits) == {0: 0.5, 3: 0.25, 4: 0.25}
    assert sorted(fits.calls) == [(i, 10) for i in range(1, 6)]
    fits.calls.clear()
    again = TrialLog(spark, str(tmp_path))  # a second run, after the first has ended
    assert run_missing(again, "d", "f", points, 10, fits) == {0: 0.5, 3: 0.25, 4: 0.25}
    assert sorted(fits.calls) == [(2, 10), (3, 10)]  # only those that failed
    best = again.best().collect()
    keys = [trial_key("d", "f", points[i], 10, 42) for i in (3, 4)]
    assert [(r["data_key"], r["loss"], r["trial_key"]) for r in best] == [("d", 0.25, min(keys))]
    assert again.rows().where("status = 'fail'").count() == 2 and again.rows().count() == 5
    run_missing(again, "other data", "f", points[:1], 10, fits)
    assert {r["data_key"] for r in again.best().collect()} == {"d", "other data"}


def test_a_later_success_replaces_a_failure(spark, tmp_path):
    log, fits = TrialLog(spark, str(tmp_path)), Fits({1: "broken"})
    run_missing(log, "d", "f", [{"p": 1}], 10, fits)
    fits.losses[1] = 0.75
    assert run_missing(log, "d", "f", [{"p": 1}], 10, fits) == {0: 0.75}
    assert [(r["status"], r["loss"]) for r in log.rows().collect()] == [("ok", 0.75)]


@pytest.fixture(scope="module")
def parts(spark):
    rows = [(Vectors.dense([float(i % 17), float(i % 5), float(i % 3)]), float((i % 17) ** 2 + 3 * (i % 5) * (i % 3)))
            for i in range(400)]
    df = spark.createDataFrame(rows, ["features", "LogSales"]).cache()
    return df.limit(300), df


def test_halving_finds_what_the_grid_finds_with_fewer_trees(spark, tmp_path, parts):
    train, validation = parts
    log = TrialLog(spark, str(tmp_path))
    rows = halving(log, "d", train, validation, {"maxDepth": [1, 4]}, [3, 8]).collect()
    grid = tune(spark, train, validation, {"maxDepth": [1, 4], "maxIter": [3, 8]})
    best = log.best().first()
    assert (int(best["params"]["maxDepth"]), best["budget"]) == (grid.best_params["maxDepth"], grid.best_params["maxIter"])
    assert best["loss"] == pytest.approx(grid.best_loss, abs=1e-9)
    assert sorted((r["budget"], r["params"]["maxDepth"]) for r in rows) == [(3, "1"), (3, "4"), (8, "4")]
    assert sum(r["budget"] for r in rows) < sum([3, 3, 8, 8])
    assert rmse_of(log.best_model("d"), validation) == pytest.approx(best["loss"], abs=1e-9)
    assert log.best_model("nothing") is None
