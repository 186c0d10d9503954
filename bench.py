"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the cores
(default all), ``BENCH_RUNS`` the timed runs after one warm-up (default 3; the best counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakecast import build_session  # noqa: E402
from lakecast.plans.forecasting import predict_next  # noqa: E402
from lakecast.plans.modeling import fit, load_model, random_forest, save_model  # noqa: E402
from lakecast.queries import registry  # noqa: E402
from lakecast.queries.common import DAILY, daily_table  # noqa: E402
from lakecast.session import scratch_path  # noqa: E402

HEADLINE = (
    "group_hourly",
    "group_daily",
    "encoded_daily",
    "model_daily",
    "model_hourly",
    "lags_hourly_split",
    "suite_summary",
    "isolate_good",
    "quarantine_tables",
    "anti_new_rows",
    "merge_insert_only",
    "incremental_validated",
    "incremental_curated",
    "lake_rows",
    "next_step_input_daily",
    "recursive_forecast_linear_daily",
    "backtest_linear_daily",
)


def timed(run) -> tuple[float, object]:
    started = time.perf_counter()
    result = run()
    return time.perf_counter() - started, result


def forest_times(spark, sf_dir: str, runs: int) -> dict[str, float]:
    """The published forest's fit, once, and the next step of a fitted one, apart."""
    table = daily_table(spark, sf_dir)
    fit_s, model = timed(lambda: fit(table, DAILY.features, random_forest(DAILY.value)))
    path = scratch_path(spark, "bench-model")
    save_model(model, path)

    def step() -> None:
        predict_next(table, DAILY, load_model(path)).write.format("noop").mode("overwrite").save()

    return {"forest_fit_daily": round(fit_s, 3), "forest_next_step_daily": round(min(timed(step)[0] for _ in range(runs + 1)), 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    shuffles = str(os.cpu_count() if cpus == "*" else int(cpus))
    spark = build_session(
        "lakecast-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=shuffles,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    found, times = registry(), {}
    for name in HEADLINE:
        best = None
        for attempt in range(runs + 1):
            elapsed, _ = timed(lambda query=found[name]: query.run(spark, sf_dir).write.format("noop").mode("overwrite").save())
            if attempt and (best is None or elapsed < best):
                best = elapsed
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    times |= forest_times(spark, sf_dir, runs)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, best of runs, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
