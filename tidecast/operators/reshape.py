"""Wide -> long reshaping."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.columns import quoted_name

#: Value columns beyond which one array is exploded: an ``Expand`` has one
#: projection for each column, and planning and compiling them costs more
#: than the rows do.
WIDE = 64

DAY_COLUMN = re.compile(r"^d_\d+$")


def day_columns(df: DataFrame, pattern: re.Pattern[str] = DAY_COLUMN) -> list[str]:
    """Value columns picked by name rather than by position, so a reordered
    or extended file still melts the right columns."""
    return [c for c in df.columns if pattern.match(c)]


def pack(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str], name: str = "cells") -> DataFrame:
    """The value columns as one array column: what meets other tables before
    it is melted is a row of a few columns, not of thousands. The columns go
    to Spark as one text, not as thousands of ``Column`` objects."""
    return df.select(*id_vars, F.expr(f"array({', '.join(map(quoted_name, value_vars))})").alias(name))


def column_numbers(df: DataFrame, value_vars: Sequence[str], var_name: str, at_name: str) -> DataFrame:
    """One row for each value column: its name and its number, from 0."""
    names = F.from_json(F.lit(json.dumps(list(value_vars))), "array<string>")
    return df.sparkSession.range(1).select(F.posexplode(names).alias(at_name, var_name))


def melt(
    df: DataFrame,
    id_vars: Sequence[str],
    value_vars: Sequence[str] | None = None,
    var_name: str = "variable",
    value_name: str = "value",
    packed: str | None = None,
    at_name: str | None = None,
) -> DataFrame:
    """One output row per (input row, value column); null values are kept.

    ``DataFrame.unpivot`` plans as a single ``Expand`` node: rows stream
    through without building an array per row. With more than ``WIDE`` value
    columns the row's values are exploded from one array with their position,
    which names the column. Both are narrow (no shuffle), so they scale with
    the input partitions. Value columns must share a type. ``packed`` names
    the array that already holds them (:func:`pack`), in that order;
    ``at_name`` adds the number of the value column, from 0, a cheaper key
    than its name for tables made by :func:`column_numbers`.
    """
    values = list(value_vars) if value_vars is not None else day_columns(df)
    if not values:
        raise ValueError("melt needs at least one value column")
    if packed is None and (at_name is not None or len(values) > WIDE):
        packed = "_cells"
        df = pack(df, id_vars, values, packed)
    if packed is not None:
        names = F.from_json(F.lit(json.dumps(values)), "array<string>")
        cells = df.select(*id_vars, F.posexplode(packed).alias("_at", value_name))
        at = [F.col("_at").alias(at_name)] if at_name is not None else []
        return cells.select(*id_vars, F.get(names, F.col("_at")).alias(var_name), value_name, *at)
    return df.unpivot(list(id_vars), values, var_name, value_name)
