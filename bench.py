"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of parquet files, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from ledgerloom.queries import QUERIES
from ledgerloom.session import local_session

HEADLINE = (
    "total_orders_by_month",
    "stg_orders",
    "int_orders_enriched",
    "fct_orders",
    "mart_commercial_kpis",
    "mart_country_targets",
    "int_customer_rfm",
    "mart_customer_kpis",
    "clean_orders",
    "orders_enriched",
    "customer_analytics",
    "retention",
    "kpis_commercial",
    "country_kpis",
    "disc_impact",
    "describe_orders",
    "quality_report",
    "source_tests",
)


def seconds(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    seconds(spark, "mart_commercial_kpis", folder)  # start-up and code generation are not measured
    timings = {name: seconds(spark, name, folder) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
