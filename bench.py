"""Time the headline queries on one machine and print one JSON line.

Every query is run once to warm up and then BENCH_RUNS times (default 3); the
reported time is the median.  A run computes every row and column and discards
them in a no-op sink.  Arguments name other queries; ``all`` takes every one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from climcube.session import local_session
from climcube.workload.queries import registry


HEADLINE = (
    "yearly_mean", "climatology", "region_join", "region_join_table", "grid_subtract",
    "model_anomaly_series", "all_series", "ensemble_running_mean", "ensemble_map_levels",
    "trend_variability", "dedupe_time", "coverage_gaps", "version_pick", "checksum_verify",
    "skip_existing", "acquisition_audit", "country_centroid",
)


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = list(registry()) if sys.argv[1:] == ["all"] else sys.argv[1:] or list(HEADLINE)
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "8g"),
                          **{"spark.ui.showConsoleProgress": "false"})
    times = {}
    for name in chosen:
        query = registry()[name]
        run(query, spark, sf_dir)
        times[name] = round(statistics.median(run(query, spark, sf_dir) for _ in range(repeats)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "runs": repeats,
    }))


if __name__ == "__main__":
    main()
