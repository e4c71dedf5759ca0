"""tidecast: retail sales forecasting on Spark.

Wide daily sales are reshaped to long form, joined with prices and a
calendar, summed by store/department/day and turned into log, lag, imputed
and encoded features. A chronological split feeds gradient-boosted trees and
per-series seasonal forecasts; the family with the lower error wins.

Everything is expressed with DataFrames, ``pyspark.ml`` stages and one grouped
pandas function, so Catalyst and AQE choose the physical plan.
"""

from tidecast.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
