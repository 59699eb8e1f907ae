"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orewright.plans.catalog import QUERIES
from orewright.session import local_session

HEADLINES = [
    "daily_sales", "category_performance", "customer_value", "dim_customer", "fact_sales", "dedupe_latest",
    "income_statement", "rpt_trial_balance", "budget_vs_actuals", "fact_gl_activity", "je_balanced",
    "dept_summary", "performance_by_dept", "sensor_averages", "temp_trend", "latest_per_device",
    "critical_alerts", "revenue_by_dept", "efficiency_metrics", "customer_360", "retail_metrics",
    "suspected_duplicates", "stream_tumbling_stats",
]


def timed(spark, name: str, folder: str) -> float:
    """Seconds to plan and run a query to its last row, without collecting it."""
    started = time.perf_counter()
    QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    timed(spark, HEADLINES[0], folder)  # the first query pays for starting the JVM
    seconds = {name: round(timed(spark, name, folder), 3) for name in HEADLINES}
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    scale = re.search(r"sf([0-9.]+)", folder)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder, "lineitem_rows": rows,
                "cpus": spark.sparkContext.defaultParallelism,
            }
        )
    )


if __name__ == "__main__":
    main()
