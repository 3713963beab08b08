"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the ``noop`` sink (every row is produced, nothing is
collected to the driver). A warm-up pass on the smallest data set loads the JVM classes
first; then each query runs ``BENCH_REPEAT`` times and the fastest run counts. ``daily_run``
is the whole daily job (one load of all sources into a fresh warehouse, then the four
reports), run once. ``rows_per_sec`` divides the rows a step consumes by its time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_rides",                # pivot + header join + point-in-time lookup
    "ride_driver_lookup",
    "clients_hist",              # SCD2 versions, interval join, running sums
    "drivers_payments",          # as-of dimension join
    "drivers_violations_full",   # split running count
    "drivers_overtime",          # 24 h sliding window
    "drivers_overtime_clipped",  # band self-join
    "events_sliding_24h",        # split sliding sum on events
    "scd2_clients",
    "upsert_update",
    "insert_ignore",
]


def daily_run(spark, sf_dir: str) -> None:
    """The whole daily job once: one load of every source (facts, dimensions, ledger) and the four
    reports of the report day, written to a fresh warehouse under the checkpoint folder."""
    import datetime as dt

    from cabwh.plans.pipeline import Inputs, Pipeline
    from cabwh.session import scratch_path
    from cabwh.sources.fixtures import REPORT_DAY, load_sources

    src = load_sources(spark, sf_dir)
    at = dt.datetime(2024, 2, 1)
    p = Pipeline(spark, scratch_path(spark, "bench-warehouse"))
    p.run_etl(Inputs(rides=src.rides, movement=src.movement, drivers=src.current("drivers", at),
                     car_pool=src.current("car_pool", at), waybills=src.waybills, payments=src.payments),
              started_at=at)
    p.run_marts(REPORT_DAY)


def input_rows(spark, sf_dir: str) -> dict[str, int]:
    """Rows each measured step consumes (counted outside the timings)."""
    from cabwh.plans.warehouse import Warehouse
    from cabwh.sources.fixtures import load_sources
    from cabwh.sources.tables import read_table

    src, wh = load_sources(spark, sf_dir), Warehouse(spark, sf_dir)
    return {
        "ride_driver_lookup": wh.finished.count(),
        "events_sliding_24h": read_table(spark, sf_dir, "events", ["event_id"]).count(),
        "clients_hist": wh.dim_clients.count(),
        "daily_run": src.movement.count() + src.waybills.count() + src.payments.count(),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from cabwh.plans.queries import REGISTRY
    from cabwh.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="cabwh-bench")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for name in HEADLINE:
            REGISTRY[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    t0 = time.perf_counter()
    daily_run(spark, sf_dir)                      # writes a warehouse: measured once
    times["daily_run"] = round(time.perf_counter() - t0, 3)
    rows = input_rows(spark, sf_dir)
    rate = {k: round(n / times[k]) for k, n in rows.items() if times.get(k)}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "rows_per_sec": rate,
    }))


if __name__ == "__main__":
    main()
