"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every query
is run to its last row (no-op sink); a query that writes or runs jobs while it is
planned has that time included. One untimed pass warms the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quern.plans.catalog import ENTRIES  # noqa: E402
from quern.session import build_session  # noqa: E402

HEADLINE = (
    # sales and loyalty reports
    "sales_by_category", "top_customers", "discount_usage_by_method", "monthly_sales",
    "discount_vs_gross", "total_spent_by_customer", "first_items", "favourite_items",
    "last_before_join", "loyalty_points_promo",
    # epidemic, cleaning, panel
    "new_cases_by_date", "running_vaccinations", "vaccination_pct", "backfill_self_join",
    "duplicate_rows", "dedupe_keep_first", "payment_summary", "top_bottom_groups", "payment_trend",
    # measurement
    "violation_pct", "rolling_mean_7", "seasonal_decompose_additive", "welch_t_test",
    "chi_square_independence", "ols_fit",
    # transactions
    "validate_transactions", "decision_time_features", "chronological_split", "sample_negatives",
    "review_policy", "evaluate_policy", "threshold_search", "probability_metrics",
    "calibration_table", "daily_monitoring",
)


def run(name: str, spark, folder: str) -> float:
    spark.catalog.clearCache()  # nothing an earlier run kept may serve this one
    start = time.perf_counter()
    ENTRIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in names:
        run(name, spark, folder)
    timings = {name: round(run(name, spark, folder), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
