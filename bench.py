"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from dockflow.plans.queries import QUERIES
from dockflow.session import build_session, clear_scratch

HEADLINE = [
    "hourly_inbound",
    "hourly_outbound",
    "hourly_net_flow",
    "hourly_flows_joined",
    "od_net_flow",
    "hourly_weather",
    "silver_hourly",
    "model_frame",
    "monthly_trips",
    "daily_trips",
    "holiday_effect",
    "daily_trips_weather",
    "weather_correlation_zero",
    "count_by_bike_type",
    "hour_by_weekday",
    "usage_matrix",
    "od_counts_out",
    "top_partners_out",
    "station_coordinates",
    "null_profile",
    "duplicate_check",
    "dedup_weather",
    "latest_as_of",
    "status_with_weather",
    "forward_fill",
    "running_bikes",
    "running_inventory",
    "gold_inventory",
    "attach_regressors",
    "seasonal_profile",
    "cv_folds",
    "cv_metrics",
    "best_params",
    "residual_distribution",
    "price_percentiles",
    "ridge_forecast",
    "ridge_grid_search",
    "registry_latest",
    "csv_round_trip",
    "clustered_round_trip",
    "stream_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "dockflow-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds, first = {}, {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        # the first run compiles code and warms caches, and stands beside; the median of the others counts
        first[name] = round(took[0], 3)
        seconds[name] = round(statistics.median(took[1:]), 3)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_runs": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
