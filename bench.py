"""Benchmark: load the warehouse from driver data, then run every registered
query.  Prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; median per query, warm).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tripwright.plans.pipeline import _BUILT, PipelineOptions, warehouse_for
    from tripwright.plans.registry import QUERIES
    from tripwright.session import get_session

    spark = get_session(f"local[{cpus}]", app_name="tripwright-bench",
                        shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})

    # Warm-up (untimed): one load of the smallest driver data set, so the
    # timed loads below are warm like the query timings.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warehouse_for(spark, small if os.path.isdir(small) else sf_dir,
                  PipelineOptions(log_name="bench-warmup"))

    # Ingest: `runs` fresh warehouse builds, median; queries then use the last.
    ingest = []
    for i in range(runs):
        opts = PipelineOptions(log_name=f"bench-{i}")
        t0 = time.perf_counter()
        warehouse_for(spark, sf_dir, opts)
        ingest.append(time.perf_counter() - t0)
    _BUILT[(spark.sparkContext.applicationId, sf_dir, PipelineOptions(), "stage_from_sf")] = \
        _BUILT[(spark.sparkContext.applicationId, sf_dir, opts, "stage_from_sf")]

    times: dict[str, float] = {"ingest_pipeline": round(statistics.median(ingest), 3)}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t)
        times[name] = round(statistics.median(samples), 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds_incl_ingest",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "warmup": "one untimed load of sf0.001 before timing",
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
