"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Each query is written to the no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from access_spark.session import local_session  # noqa: E402
from catalog import QUERIES  # noqa: E402

HEADLINE = (
    "nearest_school_times", "weighted_quintiles", "indicator_cube", "k_nearest_schools", "nearest_wealth_tile",
    "point_in_polygon", "finalized_registry", "building_ids", "area_classes", "population_grid",
    "least_cost_minutes", "shared_point_evidence", "collapsed_schools", "country_summary", "normalize_name",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(int(cpus) if cpus.isdigit() else cpus, "bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before timing
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": float(found.group(1)) if found else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
