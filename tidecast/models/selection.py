"""Scoring forecasts against actuals and choosing a model.

Predictions are paired with actuals by key and date in a join, never by row
position, and the error is an aggregate, so nothing is collected to the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.functions.metrics import rmse
from tidecast.operators.joins import null_safe_join

# Lower number wins an exact tie in error: the per-series seasonal family
# is kept unless trees are strictly better.
FAMILY_PRIORITY = {"series": 0, "trees": 1, "baseline": 2}


def join_pred_actual(actuals: DataFrame, predictions: DataFrame, keys: Sequence[str],
                     how: str = "left") -> DataFrame:
    """Actual rows with their prediction (null where none was made). A null
    key meets a null key, as in the sums that made the rows."""
    return null_safe_join(actuals, predictions, list(keys), how)


def on_common_rows(scored: DataFrame, keys: Sequence[str], models: Sequence[str], label_col: str,
                   prediction_col: str, model_col: str = "model") -> DataFrame:
    """The rows of keys for which every one of ``models`` has a prediction and
    the label is known, so that all models are compared on the same rows. A
    group holds one row for each model."""
    known = F.col(label_col).isNotNull() & F.col(prediction_col).isNotNull() & ~F.isnan(prediction_col)
    # One bit for each model: a number is kept for a group, not a set.
    bits = F.lit(0)
    for i, name in enumerate(sorted(set(models))):
        bits = F.when(F.col(model_col) == name, 1 << i).otherwise(bits)
    rows = scored.where(known & F.col(model_col).isin(list(models))).withColumn("_bit", bits.cast("long"))
    return rows.withColumn("_seen", F.bit_or("_bit").over(Window.partitionBy(*keys))) \
        .where(F.col("_seen") == (1 << len(set(models))) - 1).drop("_bit", "_seen")


def rmse_by_model(scored: DataFrame, label_col: str, prediction_col: str,
                  model_col: str = "model", by: Sequence[str] = ()) -> DataFrame:
    """RMSE per model (and per ``by`` group) over rows with a prediction."""
    return scored.groupBy(model_col, *by).agg(
        rmse(label_col, prediction_col).alias("rmse"),
        F.count(F.col(prediction_col)).cast("long").alias("n"),
    )


def select_best_model(scores: DataFrame, by: Sequence[str] = (), loss_col: str = "rmse",
                      model_col: str = "model", family_col: str = "family") -> DataFrame:
    """Per ``by`` group, the row with the lowest loss; ties go to the family
    with the lower priority number, then to the model name. Models without
    a loss are skipped."""
    priority = F.coalesce(
        F.try_element_at(F.create_map(*[x for k, v in FAMILY_PRIORITY.items()
                                    for x in (F.lit(k), F.lit(v))]), F.col(family_col)),
        F.lit(len(FAMILY_PRIORITY)))
    ranked = scores.where(F.col(loss_col).isNotNull()).withColumn("_p", priority)
    best = F.min(F.struct(F.col(loss_col).alias("loss"), F.col("_p").alias("p"),
                          F.col(model_col).alias("m"), F.col(family_col).alias("f")))
    chosen = ranked.groupBy(*by).agg(best.alias("_best"))
    return chosen.select(*by, F.col("_best.m").alias(model_col), F.col("_best.f").alias(family_col),
                         F.col("_best.loss").alias(loss_col))


def save_model(model: Model, path: str) -> None:
    """Keep a fitted model of any family; an existing folder is not replaced."""
    model.write().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """The model kept at ``path``, as the class that its metadata names."""
    return DefaultParamsReader.loadParamsInstance(path, spark)
