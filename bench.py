"""Time the headline queries, the median of three runs each; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from hearthline.session import build_session
from hearthline.workload.queries import QUERIES

HEADLINE = [
    "bronze_records",
    "bronze_array_elements",
    "dead_letter",
    "exact_dedup",
    "fuzzy_dedup",
    "fuzzy_dedup_no_time",
    "candidate_pairs",
    "gold_washing",
    "gold_coffee",
    "gold_dishwasher",
    "device_summary",
    "quality_metrics",
    "replay_cumulative",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("device_summary")  # start-up of the session and of its generated code
    seconds = {name: round(statistics.median(run(name) for _ in range(3)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
