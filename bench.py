"""Times the headline queries: ``python bench.py`` prints one JSON line.

``BENCH_SF_DIR`` names the folder of parquet tables, ``BENCH_CPUS`` the number of local cores.
Results are written to a sink that discards them, so every row is computed.  ``run_historical`` is a
whole run, from writing its CSV drops to the checked star schema (150,000 orders at sf0.1).
"""

from __future__ import annotations

import json
import os
import sys
import time

from ordermill.registry import all_queries
from ordermill.session import build_session

HEADLINE = (
    "vw_daily_orders",
    "vw_daily_revenue",
    "vw_restaurant_performance",
    "vw_delivery_performance",
    "vw_customer_summary",
    "vw_payment_summary",
    "q01_daily_orders",
    "q02_daily_revenue",
    "q03_average_order_value",
    "q04_cancellation_rate",
    "q05_payment_success_rate",
    "q06_revenue_by_city",
    "q07_orders_by_restaurant",
    "q08_top_restaurants",
    "q09_orders_by_cuisine",
    "q10_average_delivery_time",
    "q11_late_deliveries",
    "q12_customer_order_frequency",
    "q13_repeat_customers",
    "q14_monthly_revenue",
    "q15_peak_ordering_hours",
    "mon_recent_runs",
    "mon_quality_trend",
    "mon_slowest_stages",
    "dq_unique",
    "dq_exists_in",
    "dq_quality_score",
    "cln_dedupe",
    "trf_order_analytics",
    "trf_daily_metrics",
    "wh_merge_scd1",
    "wh_resolve_fact_order",
    "chk_fact_keys",
    "run_historical",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = build_session(
        "ordermill bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    registered["q01_daily_orders"](spark, folder).write.format("noop").mode("overwrite").save()

    times, failed = {}, {}
    for name in wanted or HEADLINE:
        started = time.perf_counter()
        try:
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        except Exception as error:  # noqa: BLE001 - the other figures are still wanted
            failed[name] = f"{type(error).__name__}: {error}"[:300]
            continue
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
            | ({"failed": failed} if failed else {})
        )
    )
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
