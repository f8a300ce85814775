"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. `warehouse_build` goes from the raw tables to
the written fact and order summary; the other queries run on the warehouse it leaves. Every
query runs once to warm up the JVM and then BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from salesloom.plans import catalog
from salesloom.plans.marts import MART_NAMES
from salesloom.session import build_session

QUERIES = (
    *MART_NAMES,
    "report_topline", "kpi_cards", "region_rollup", "category_rollup", "ltv_tier_stats", "top15_products",
    "cohort_matrix", "revenue_share", "clean_customers", "clean_orders", "clean_order_items", "fact_summary",
    "orphan_checks", "quality_report",
)


def timed(action) -> float:
    start = time.monotonic()
    action()
    return time.monotonic() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else None)
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()

    def drain(name: str) -> None:
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    cold = timed(lambda: catalog.warehouse(spark, sf_dir).order_sales)
    seconds["warehouse_build"] = timed(lambda: catalog.new_warehouse(spark, sf_dir).order_sales)
    for name in QUERIES:
        drain(name)
        seconds[name] = statistics.median(timed(lambda: drain(name)) for _ in range(runs))
    rounded = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "cpus": cpus,
                "first_build_in_cold_jvm": round(cold, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
