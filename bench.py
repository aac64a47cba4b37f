"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of test tables, ``BENCH_CPUS`` the number of local cores.
Every result is computed in full and written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from pacegrid.plans.queries import QUERIES
from pacegrid.session import local_session

HEADLINE = [
    "km_splits",
    "activity_metrics",
    "first_gps_point",
    "dedupe_stream",
    "dim_date",
    "week_kpis",
    "squad_4week",
    "history_weekly",
    "day_grid",
    "recent_20",
    "personal_bests",
    "training_block",
    "readiness_summary",
    "pb_trend",
    "source_effort",
    "race_backtest_blended",
    "sensitivity_grid",
    "extract_nested_id",
    "repair_text",
    "explode_streams",
    "insert_only_load",
    "upsert_load",
    "quality_suite",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.read.parquet(f"{folder}/orders.parquet").count()  # start-up is not measured
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
