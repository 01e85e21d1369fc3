"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retinue.catalog import QUERIES  # noqa: E402
from retinue.session import build_session  # noqa: E402

HEADLINE = [
    "job_customer_features",
    "job_customer_features_staged",
    "job_recency_frequency",
    "job_monetary",
    "job_satisfaction",
    "job_diversity",
    "job_order_sequence",
    "job_trend",
    "job_payments",
    "job_constraints",
    "job_dedup_reviews",
    "job_monthly_revenue",
    "job_top_categories",
    "job_kpis",
    "job_segment_profile",
    "job_churn_calibration",
    "job_at_risk_top",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    # One untimed run loads classes and warms the code cache.
    QUERIES["job_customer_features"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
