"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   input tables        (default /root/testdata/sf0.1)
BENCH_CPUS     local cores         (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 3; the median counts)

Results go to the ``noop`` sink.  ``raw_to_mart`` is the whole job from the raw
tables, every stage written anew on each run.  The other queries read the table
the stage before them wrote.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weekcast.plans.jobs import run_stages  # noqa: E402
from weekcast.plans.registry import QUERIES, stages  # noqa: E402
from weekcast.session import local_session  # noqa: E402
from weekcast.sources import star_schema  # noqa: E402
from weekcast.sources.shared import shared_folder, write_stage  # noqa: E402

HEADLINE = [
    "promo_filter_global", "price_stats", "price_refinement", "sales_promo_join",
    "missing_weeks", "gap_fill", "panel", "panel_sorted", "qty_lookup", "dedupe_first",
    "moving_avg_ref", "moving_avg_cor", "shifted_join", "seasonality_ref", "seasonality_cor",
    "drop_inactive", "base_window_ref", "week_of_year_seasonality_ref",
    "week_of_year_seasonality_cor", "forecast_ref", "forecast_cor", "reforecast_ref",
    "reforecast_recompute", "reforecast_cor", "resolve_params", "mart_before", "drill_down",
    "item_list", "series_array",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def raw_to_mart(spark, sf_dir: str) -> None:
    folder = shared_folder(spark)
    weekly = write_stage(star_schema.weekly_lines(spark, sf_dir), folder, "weekly_lines")
    sales = write_stage(star_schema.sales(weekly), folder, "sales")
    promo = write_stage(star_schema.promotions(weekly), folder, "promotions")
    run_stages(spark, sales, promo, folder=folder)


def timed(run, runs: int) -> float:
    seconds = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    results = {"raw_to_mart": timed(lambda: raw_to_mart(spark, sf_dir), runs)}
    prepared = stages(spark, sf_dir)
    for name in ("lines", "sales", "promotions", "joined", "panel", "seasonal", "seasonal_cor", "mart"):
        getattr(prepared, name)
    for name in HEADLINE:
        results[name] = timed(lambda: consume(QUERIES[name](spark, sf_dir)), runs)
        print(f"{name} {results[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "sum of median query times",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
