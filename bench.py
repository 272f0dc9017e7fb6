"""Time the headline queries; prints one JSON line.

Each query runs once unmeasured (compilation, file listing), then RUNS times;
its time is the median. A query's whole result is computed and discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from visitloom.plans.catalog import QUERIES  # noqa: E402
from visitloom.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "scan_actions_by_date",
    "session_rollup",
    "session_full_info",
    "filter_sessions",
    "session_detail_filtered",
    "session_aggr_stat",
    "extract_quota_per_hour",
    "session_random_extract",
    "extract_session_detail",
    "category_counts",
    "session_category_activity",
    "top10_category",
    "top10_session",
    "top10_session_detail",
)


def main() -> None:
    spark = build_session(
        "visitloom-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for run in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            if run:
                taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    line = {
        "metric": "session analytics, sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
