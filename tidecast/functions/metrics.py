"""Error measures as aggregate expressions (evaluated where the data lives,
never on driver-side arrays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_error(label: str, prediction: str) -> Column:
    return F.pow(F.col(label) - F.col(prediction), 2)


def rmse(label: str, prediction: str) -> Column:
    """Root mean squared error over rows where both sides are present."""
    err = F.when(F.col(label).isNotNull() & F.col(prediction).isNotNull(),
                 squared_error(label, prediction))
    return F.sqrt(F.avg(err))
