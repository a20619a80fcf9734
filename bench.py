"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

First the warehouse is materialised once (raw layer derived from the test
tables, model outputs, marts: the refresh), timed as ``materialize_sec``.
Then each query is fully executed into Spark's no-op sink (every row
computed, nothing collected); the time per query is the median of warm
runs, and ``value`` is their sum.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "executive_metrics", "sales_trend", "store_sales", "department_sales", "fact_demand", "dim_date",
    "int_sales_features", "baseline_forecast", "forecast_results", "forecast_metrics", "forecast_trend",
    "forecast_detail", "demand_detail", "stockout_risk", "stockout_queue", "risk_summary", "sales_anomalies",
    "anomaly_candidates", "anomaly_queue", "training_frame", "next_week_rows", "time_split_sizes",
    "not_null_report", "relationship_report", "pipeline_health", "governed_store_sales",
)


def main() -> None:
    from shelfcast.plans.registry import QUERIES
    from shelfcast.plans.warehouse import Warehouse
    from shelfcast.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", "shelfcast-bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    t0 = time.perf_counter()
    Warehouse.shared(spark, sf_dir).layer_tables()  # materialise every layer once
    materialize = time.perf_counter() - t0
    run(names[0])  # JVM warm-up
    times = {}
    for name in names:
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "materialize_sec": round(materialize, 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
