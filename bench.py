"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and forces full evaluation through the ``noop`` sink
(every row is computed, nothing is pulled to the driver). Prints one JSON
line: total seconds plus seconds per query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidecast.plans.catalog import QUERIES  # noqa: E402
from tidecast.session import build_session  # noqa: E402

HEADLINE = [
    "daily_sales",
    "lag_features",
    "impute_mean",
    "split_train",
    "encoded_features",
    "melt",
    "join_inner_multikey",
    "forecast_trend",
    "select_best_model",
    "forecast_fourier",
    "gbt_rmse",
    "model_choice",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app_name="tidecast-bench",
                          shuffle_partitions=int(cpus) * 2, driver_memory="16g")
    # JVM and code-path warm-up, not timed.
    for warm in ("series_key", "revenue", "null_profile"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
