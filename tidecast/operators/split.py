"""Chronological splits without leaking the future.

``percent_rank`` over an un-partitioned window sends every row to one task.
Here the rank is computed on the per-time-value counts instead: a table with
one row per distinct time value (days), whose size is set by the length of
the time axis and not by the row count. Its running sum gives, for each time
value, the number of earlier rows; joined back, that equals
``percent_rank()`` exactly, ties included, so a day is never split between
train and test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.joins import null_safe_join
from tidecast.session import materialize


def time_rank_table(df: DataFrame, time_col: str, rank_col: str = "rank") -> DataFrame:
    """(time value, percent rank) for every distinct time value."""
    counts = df.groupBy(time_col).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(everything))
        .select(
            time_col,
            F.when(F.col("_total") <= 1, F.lit(0.0))
            .otherwise(F.col("_before") / (F.col("_total") - 1))
            .alias(rank_col),
        )
    )


def distributed_rank_table(df: DataFrame, time_col: str, rank_col: str = "rank",
                           partitions: int | None = None) -> DataFrame:
    """The same for a time axis that is itself large (timestamps): the counts
    are dealt to range partitions and written, each partition is summed by
    itself, and the rows before a partition are added from one number for each
    partition. No task holds more than its range."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(time_col).agg(F.count(F.lit(1)).alias("_n"))
    ranged = materialize(counts.repartitionByRange(n, time_col).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.sum("_n").alias("n")).collect()}
    before, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(part, 0)
    inside = Window.partitionBy("_part").orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.get(F.array(*[F.lit(b).cast("long") for b in before or [0]]), F.col("_part"))
    rank = (offset + F.coalesce(F.sum("_n").over(inside), F.lit(0))) / F.lit(max(total - 1, 1))
    return ranged.select(time_col, rank.cast("double").alias(rank_col))


def distributed_percent_rank(df: DataFrame, time_col: str, rank_col: str = "rank",
                             partitions: int | None = None) -> DataFrame:
    """:func:`time_percent_rank` by way of :func:`distributed_rank_table`."""
    ranks = distributed_rank_table(df, time_col, rank_col, partitions)
    return null_safe_join(df, ranks, [time_col], "inner")


def time_percent_rank(df: DataFrame, time_col: str, rank_col: str = "rank") -> DataFrame:
    """``df`` plus ``percent_rank() OVER (ORDER BY time_col)``.

    The rank table is derived, so it is not counted up front (that would
    run the whole upstream plan twice). It leaves an exchange whose exact
    size AQE measures at run time; below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` the join becomes a
    broadcast hash join, above it stays a shuffle join. Null time values
    rank first, as in ``percent_rank``.
    """
    ranks = time_rank_table(df, time_col, rank_col).withColumnRenamed(time_col, "_t")
    joined = df.join(ranks, df[time_col].eqNullSafe(ranks["_t"]), "inner")
    return joined.drop("_t")


def time_split(df: DataFrame, time_col: str, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test): rows with time percent rank <= ratio, and the rest."""
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be within [0, 1]")
    ranked = time_percent_rank(df, time_col, "_rank")
    train = ranked.where(F.col("_rank") <= F.lit(ratio)).drop("_rank")
    test = ranked.where(F.col("_rank") > F.lit(ratio)).drop("_rank")
    return train, test


def cutoff_side(date_col: str, cutoff: str, side_col: str = "side"):
    """'train' on or before the cutoff date, 'test' after it."""
    limit = F.lit(cutoff).cast("date")
    return (F.when(F.col(date_col).cast("date") <= limit, F.lit("train"))
            .when(F.col(date_col).cast("date") > limit, F.lit("test"))
            .alias(side_col))


def cutoff_split(df: DataFrame, date_col: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a typed date cutoff; both filters reach the scan."""
    limit = F.lit(cutoff).cast("date")
    d = F.col(date_col).cast("date")
    return df.where(d <= limit), df.where(d > limit)
