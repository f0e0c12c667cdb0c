"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full
computation including any plan-time jobs such as broadcast size checks and
model fits; no collect to the driver). Every query runs ``$BENCH_REPEAT``
times (default 3) and the best wall time is reported (the first run pays
code generation for that plan shape). Prints ONE JSON line:
{"metric", "value", "unit", "queries": {name: sec}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hourgrid.plans.catalog import QUERIES  # noqa: E402
from hourgrid.session import get_session  # noqa: E402

HEADLINE = [
    "feature_table",
    "merged_hourly",
    "lag_rolling_features",
    "supplier_daily_features",
    "interpolate_gaps",
    "capacity_fill",
    "clean_train",
    "forecast_county",
    "weather_joined",
    "category_all",
    "monthly_change",
    "daily_moving_avg",
    "growth_rate",
    "series_completeness",
    "naive_scores",
    "fold_membership",
    "gbt_backtest",
    "supplier_gbt_backtest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in sys.argv[1:] if q in QUERIES]
    names = only or HEADLINE
    spark = get_session(f"local[{cpus}]", "hourgrid-bench",
                        {"spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))),
                         "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up: JIT, class loading, file listing
    QUERIES["monthly_change"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    times: dict[str, float | None] = {}
    failed = []
    for name in names:
        best = None
        try:
            for _ in range(max(1, repeat)):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
                spark.catalog.clearCache()
        except Exception as exc:  # noqa: BLE001 - one failing query must not hide the others
            print(f"bench: {name} failed: {exc}", file=sys.stderr)
            failed.append(name)
            best = None
        times[name] = round(best, 3) if best is not None else None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_wall_time_headline_queries",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
