"""Time the headline queries and print one JSON line.

Every query is read in full (noop sink). BENCH_SF_DIR and BENCH_CPUS choose the
data folder and the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from turnstile.plans.queries import QUERIES
from turnstile.session import local_session

HEADLINE = (
    "eid_month_counts",
    "balanced_groups",
    "enrich_badges",
    "normalise_badges",
    "first_last_tags",
    "pair_stays",
    "eid_daily",
    "hourly_occupancy",
    "quality_profile",
    "quality_rollup",
    "peak_rollup",
    "retain_weekly",
    "monthly_eid_daily",
    "monthly_peak_util",
    "monthly_data_quality",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    run(spark, "monthly_peak_util", sf_dir)  # warm-up, not counted
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
