"""Headline queries, timed: one JSON line on stdout.

Each query rebuilds its inputs from the driver tables; ``mart_run_status``
builds all seven marts over shared tables.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from orderlens.catalog.queries import QUERIES
from orderlens.session import local_session

HEADLINE = (
    "incremental_order_items", "incremental_children", "parse_mixed_timestamps", "price_anomalies", "line_revenue",
    "clv_daily", "customer_segments_rfm", "rfm_scores_distributed", "churn_risk", "sales_trends", "loyalty_impact",
    "location_performance", "price_tier_mart", "free_item_order_value", "dq_percentiles", "dq_account_profile",
    "mart_run_status",
)


def main(queries=QUERIES, names=HEADLINE) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(
        "bench", cores, memory="16g", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")}
    )
    queries["sales_trends"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up

    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
