"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_REPEAT   timed runs per query after one warm-up (default 3, median kept)
BENCH_QUERIES  comma-separated names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

import pyspark

sys.path.insert(0, str(Path(__file__).resolve().parent))

from weirline.session import build_session  # noqa: E402
from weirline.workload.registry import queries  # noqa: E402

HEADLINE = (
    "dedup_keep_first",
    "outlier_filter",
    "fill_median",
    "clean_customers",
    "clean_products",
    "clean_orders",
    "clean_web_events",
    "clean_targets",
    "etl_audit",
    "quality_report",
    "dim_date",
    "fact_revenue",
    "fact_revenue_enriched",
    "fact_funnel",
    "fact_targets",
    "fact_revenue_monthly",
    "fact_leakage",
    "fact_recovery",
    "vw_executive_summary",
    "vw_funnel_analysis",
    "validate_row_counts",
    "validate_funnel",
    "validate_margin",
    "kpi_measures",
    "kpi_by_region_month",
    "leakage_share_by_type",
    "recovery_by_scenario",
)


def _seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = [n for n in chosen.split(",") if n] or list(HEADLINE)

    spark = build_session("weirline-bench", f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    times = {}
    for name in names:
        _seconds(known[name], spark, sf_dir)
        runs = [_seconds(known[name], spark, sf_dir) for _ in range(repeat)]
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "spark": pyspark.__version__,
            }
        )
    )


if __name__ == "__main__":
    main()
