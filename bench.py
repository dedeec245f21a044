"""Benchmark: the streamed fact load, the fact build and the ten reports at
$BENCH_SF_DIR.

Runs on local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_report_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). A small warm-up run on the smoke data
comes first so JIT start-up is not charged to the first report.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stream_dim_join", "fact_build",
    "q01_top_products_by_day_type", "available_years", "q02_store_quarter_growth",
    "q03_supplier_contribution", "q04_seasonal_sales", "q05_monthly_volatility",
    "q06_product_affinity", "q06_events_hourly", "q07_revenue_rollup", "q08_half_year",
    "q09_revenue_spikes", "q10_store_quarter_view", "q10b_view_one_year",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from sparkmart.plans.registry import load_all
    from sparkmart.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="sparkmart-bench", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    reg = load_all()
    only = [k for k in sys.argv[1:] if k in reg]
    keys = only or HEADLINE
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for k in ("q01_top_products_by_day_type", "q07_revenue_rollup"):
            reg[k].fn(spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        reg[k].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_report_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if "stream_dim_join" in times:
        # the reference's own ETL metric: records processed per second of the load
        n = reg["fact_build"].fn(spark, sf_dir).count()
        out["etl_records_per_sec"] = round(n / times["stream_dim_join"], 1)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
