"""Column-level building blocks (scalar expressions and aggregate metrics)."""

from tidecast.functions.columns import (
    day_index,
    day_number,
    dept_key,
    revenue,
    saturday_wday,
    series_key,
)
from tidecast.functions.metrics import rmse

__all__ = [
    "day_index",
    "day_number",
    "dept_key",
    "revenue",
    "rmse",
    "saturday_wday",
    "series_key",
]
