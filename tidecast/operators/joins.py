"""Equi-joins that leave the choice of strategy to Spark.

Nothing is hinted: a side is broadcast only when its estimated or measured
bytes (adaptive execution) are below ``spark.sql.autoBroadcastJoinThreshold``;
beyond that the join shuffles, and adaptive execution splits skewed
partitions. No job counts a side beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_using(
    fact: DataFrame,
    dim: DataFrame,
    keys: str | Sequence[str],
) -> DataFrame:
    """Left equi-join on columns both sides name alike (``USING``)."""
    on = [keys] if isinstance(keys, str) else list(keys)
    return fact.join(dim, on, "left")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which a null key equals a null key, as it does
    in a grouping; the keys of the right side are dropped."""
    theirs = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(theirs)
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in theirs.items()])
    return left.join(right, cond, how).drop(*theirs.values())


def inner_join_on(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
) -> DataFrame:
    """Inner equi-join on differently named key pairs ``(left_col, right_col)``."""
    cond = None
    for lcol, rcol in pairs:
        c = left[lcol] == right[rcol]
        cond = c if cond is None else cond & c
    return left.join(right, cond, "inner")
