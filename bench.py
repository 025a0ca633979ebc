"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). A warm-up query runs first
(JVM start and first-query compilation excluded); each query then runs
$BENCH_RUNS times (default 3) and its median wall time is reported. Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_order_detail", "fact_by_milestone_dispatch", "rollup_order_cargo_1d", "rollup_receive_nd",
    "report_orders", "report_city_stats", "report_express_province", "report_driver_stats",
    "dim_complex_full", "dim_sku_full", "dim_user_zip", "latest_per_key",
    "page_module_guide_pay", "page_module_share", "cdc_order_detail_wide", "sink_partial_update",
    "label_user_profile", "moderate_comments", "blocklist_membership", "stream_cancel_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from pyspark.sql import SparkSession

    from dovetail.registry import load_all
    from dovetail.session import DEFAULTS
    b = (SparkSession.builder.master(f"local[{cpus}]").appName("dovetail-bench")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(cpus * 2)))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    names = only or HEADLINE

    def run(name: str) -> float:
        t0 = time.perf_counter()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("report_orders")  # warm-up
    out: dict[str, float] = {}
    for name in names:
        out[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(m.group(1)) if m else None, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
