"""Forecasts of single items, reconciled with those of their departments.

Items sell on few days, so their days without a sale count as zeros. No such
row is made: on a full axis of days the sums of t and t * t are constants, and
the sums of y and t * y need the sale days only. One aggregate of the sales
gives the line of every item, and the sums of the items give the departments.

A department's own forecast knows more (the weekday), the items add up to
something else. Weighted least squares moves both to the nearest point at which
the items add up to the department, each by its share of the residual variance:
with weights w and discrepancy e = department - sum of items, an item gains
w_i / (w_0 + sum w) * e and the department loses w_0 / (w_0 + sum w) * e. This
is a sum and a join by (store, department, day).

Defined results: a null key is a key; an item with one sale has a line like any
other; without any variance the discrepancy is shared equally among the items;
sales after the cutoff are not looked at; without sales there are no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.operators.joins import null_safe_join

DEPT = ["store_id", "dept_id"]
ITEM = [*DEPT, "item_id"]


@dataclass
class Axis:
    """Training days ``first`` to ``last`` and the sums over them."""

    first: int
    last: int

    def __post_init__(self):
        n, low = self.last - self.first + 1, self.first - 1

        def squares(m: int) -> int:
            return m * (m + 1) * (2 * m + 1) // 6

        self.n, self.st = n, n * (self.first + self.last) // 2
        self.stt = squares(self.last) - squares(low) if low >= 0 else sum(d * d for d in range(self.first, self.last + 1))


def _lines(sums: DataFrame, axis: Axis, keys: list[str]) -> DataFrame:
    """(keys, intercept, slope, weight): zero-filled least squares lines and
    their residual variances, from sums (sy, sty, syy)."""
    sy, sty, syy = F.col("sy"), F.col("sty"), F.col("syy")
    spread = float(axis.n * axis.stt - axis.st * axis.st)
    slope = (axis.n * sty - axis.st * sy) / spread if spread else F.lit(0.0)
    intercept = (sy - slope * axis.st) / axis.n
    weight = F.greatest((syy - intercept * sy - slope * sty) / axis.n, F.lit(0.0))
    return sums.select(*keys, intercept.alias("intercept"), slope.alias("slope"), weight.alias("weight"))


def _sums(sales: DataFrame, keys: list[str]) -> DataFrame:
    t, y = F.col("day"), F.col("sales")
    return sales.groupBy(*keys).agg(F.sum(y).alias("sy"), F.sum(t * y).alias("sty"), F.sum(y * y).alias("syy"))


def reconcile(items: DataFrame, depts: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """``items(by, ..., yhat, weight)`` and ``depts(by, yhat, weight)`` with a
    column ``reconciled`` each: the items of a group add up to its department."""
    total = items.groupBy(*by).agg(F.sum("yhat").alias("_sum"), F.sum("weight").alias("_w"), F.count(F.lit(1)).alias("_n"))
    met = null_safe_join(depts, total, by, "inner")
    gap = F.col("yhat") - F.col("_sum")
    all_weight = F.col("weight") + F.col("_w")
    shared = met.select(*by, gap.alias("_gap"), all_weight.alias("_all"), "_n")
    moved = F.when(F.col("_all") > 0, F.col("weight") / F.col("_all")).otherwise(1 / F.col("_n")) * F.col("_gap")
    out = null_safe_join(items, shared, by, "inner").withColumn("reconciled", F.col("yhat") + moved) \
        .drop("_gap", "_all", "_n")
    own = F.when(all_weight > 0, F.col("weight") / all_weight).otherwise(0.0) * gap
    return out, met.withColumn("reconciled", F.col("yhat") - own).drop("_sum", "_w", "_n")


def item_forecasts(sales: DataFrame, cutoff_day: int, horizon: int) -> tuple[DataFrame, DataFrame]:
    """(items, departments) for the ``horizon`` days after ``cutoff_day``, each
    with ``yhat`` and ``reconciled``. ``sales(store_id, dept_id, item_id, day,
    date, sales)`` has a row for each sale day of an item; it should be
    written, as it is read for the axis, the items and the departments."""
    train = sales.where(F.col("day") <= cutoff_day)
    first = train.agg(F.min("day")).first()[0]
    axis = Axis(cutoff_day if first is None else first, cutoff_day)
    days = F.explode(F.sequence(F.lit(cutoff_day + 1), F.lit(cutoff_day + horizon))).alias("day")
    line = F.col("intercept") + F.col("slope") * F.col("day")
    items = _lines(_sums(train, ITEM), axis, ITEM).select(*ITEM, "intercept", "slope", "weight", days) \
        .select(*ITEM, "day", line.alias("yhat"), "weight")

    # Departments: the line and the mean residual of each weekday. Day numbers
    # seven apart share a weekday.
    daily = train.groupBy(*DEPT, "day").agg(F.sum("sales").alias("sales"))
    lines = _lines(_sums(daily, DEPT), axis, DEPT)
    week: Column = F.pmod(F.col("day"), F.lit(7))
    by_week = daily.groupBy(*DEPT, week.alias("dow")).agg(F.sum("sales").alias("sy"))
    spark = sales.sparkSession
    sums_of_days = spark.range(axis.first, axis.last + 1).select(F.col("id").alias("day")).groupBy(
        week.alias("dow")).agg(F.count(F.lit(1)).alias("n"), F.sum("day").alias("st"))
    effects = null_safe_join(lines.crossJoin(F.broadcast(sums_of_days)), by_week, [*DEPT, "dow"])  # seven rows
    effect = (F.coalesce("sy", F.lit(0.0)) - F.col("intercept") * F.col("n") - F.col("slope") * F.col("st")) / F.col("n")
    effects = effects.select(*DEPT, "dow", "n", effect.alias("effect"))
    by_dept = effects.groupBy(*DEPT).agg(F.sum(F.col("n") * F.col("effect") * F.col("effect")).alias("_between"),
                                         F.map_from_entries(F.collect_list(F.struct("dow", "effect"))).alias("_effects"))
    weight = F.greatest(F.col("weight") - F.col("_between") / axis.n, F.lit(0.0))
    depts = null_safe_join(lines, by_dept, DEPT, "inner").select(*DEPT, "intercept", "slope", weight.alias("weight"),
                                                                 "_effects", days)
    yhat = line + F.coalesce(F.try_element_at("_effects", week), F.lit(0.0))
    depts = depts.select(*DEPT, "day", yhat.alias("yhat"), "weight")
    return reconcile(items, depts, [*DEPT, "day"])
