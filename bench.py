"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS]; prints one JSON line.

Each query is fully executed (rows written to a no-op sink) and timed end
to end, planning and its own eager steps included.  Before timing, every
headline query runs once on the smallest tables, so JVM class loading and
code generation are not charged to whichever query happens to come first.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from portmart.plans.catalog import QUERIES  # noqa: E402
from portmart.session import build_session  # noqa: E402

HEADLINE = [
    "pipeline_report",
    "q_size_vs_volume",
    "q_share_vs_volume",
    "fact_table",
    "calendar_dim",
    "dim_city",
    "clean_temperature",
    "clean_demographics",
    "first_match_lookup",
    "label_table",
    "join_two_keys",
    "pivot_sum",
    "dedup_rows",
    "sink_partitioned_2",
    "primary_key_check",
    "average_age",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        app_name="portmart-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in names:
        run(QUERIES[name](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir))
    times = {}
    for name in names:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
