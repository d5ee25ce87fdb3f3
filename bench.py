"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built from the parquet tables and fully evaluated through the
``noop`` sink (every row computed, nothing collected). $BENCH_WARMUP warm-up
runs (default 3) of the query that touches every step let the JVM compile its
hot paths (the same query takes about 40, 22, 16, then 14 s on a fresh JVM);
then $BENCH_RUNS timed runs of each query. The per-query figure is the median,
``value`` their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "changeset_rollup",
    "contributor_combined",
    "changeset_project",
    "changeset_editor",
    "session_labour",
    "first_contribution",
    "prior_experience",
    "contribution_totals",
    "stats_monthly",
    "stats_top_projects",
    "way_deletion_history",
    "uid_username_map",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from cartoledger.plans.queries import QUERIES
    from cartoledger.session import local_session

    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="cartoledger-bench")
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for _ in range(int(os.environ.get("BENCH_WARMUP", "3"))):
        QUERIES["contribution_totals"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        fn = QUERIES[name]
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            seen = Observation(name)
            df = fn(spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("rows"))
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        rows[name] = seen.get["rows"]
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "headline_queries_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
