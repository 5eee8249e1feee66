"""Benchmark headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, optional), BENCH_REPEAT (default 3: median of N),
     BENCH_WARMUP_DIR (default: the sf0.01 sibling of BENCH_SF_DIR, if present)
Each query is executed fully via the ``noop`` sink (nothing is collected).
Every headline query first runs once on the small warm-up scale so the
timed runs measure a warm JVM (JIT + generated code cached), as on a
long-running cluster; the cold first-run times are reported separately.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "transform_batch",          # raw JSON -> processed rows (the streaming transform as a batch)
    "stream_write_processed",   # the same transform as a checkpointed availableNow stream
    "scan_snapshot_decode",
    "recent_flights_500",       # page derived from the raw tables
    "recent_flights_stored",    # the serving path: page of a stored, day-partitioned table
    "agg_hourly_routes",
    "alerts",
    "dedup_states",
    "latest_state",
    "congestion",
    "agg_daily_airport_stats",
    "busiest_routes",
    "expectations",
    "histogram_quantile_p95",
    "agg_delay_patterns",
    "trajectory_window",
    "dedup_stream",             # stateful streams, landing of their input included
    "congestion_stream",
    "emergency_descent_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from pyspark.sql import functions as F

    from flight_engine.operators.serve import recent_flights, recent_flights_from_table
    from flight_engine.operators.sink import append_batch
    from flight_engine.operators.transform import process_raw, serialize_unkeyed
    from flight_engine.plans import catalog
    from flight_engine.session import get_spark, scratch_path

    spark = get_spark("bench", master=f"local[{cpus}]", shuffle_partitions=cpus)

    # landed raw messages for the transform benchmark (prepared outside the timer),
    # one file per core as a partitioned topic would land them
    raw = scratch_path(spark, "bench-raw")
    (serialize_unkeyed(catalog.states(spark, sf_dir)).repartition(cpus)
     .write.mode("overwrite").parquet(raw))

    table = scratch_path(spark, "bench-table")
    append_batch(catalog.history(spark, sf_dir), table)

    extra = {
        "transform_batch": lambda s, d: process_raw(s.read.parquet(raw)),
        "recent_flights_500": lambda s, d: recent_flights(catalog.history(s, d), 500),
        "recent_flights_stored": lambda s, d: recent_flights_from_table(s, table, 500),
    }

    warm_dir = os.environ.get("BENCH_WARMUP_DIR") or os.path.join(
        os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    catalog.history(spark, sf_dir).agg(F.count(F.lit(1))).collect()  # parquet footers
    warm_raw = scratch_path(spark, "bench-warm-raw")
    (serialize_unkeyed(catalog.states(spark, warm_dir)).repartition(cpus)
     .write.mode("overwrite").parquet(warm_raw))

    def run_on(name, d, raw_path):
        fn = extra.get(name) or catalog.QUERIES[name]
        if name == "transform_batch":
            fn = lambda s, _d: process_raw(s.read.parquet(raw_path))
        t0 = time.perf_counter()
        fn(spark, d).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    cold = {n: round(run_on(n, warm_dir, warm_raw), 3) for n in names}

    out = {}
    for n in names:
        out[n] = round(statistics.median(run_on(n, sf_dir, raw) for _ in range(repeat)), 3)
    total = round(sum(out.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "warmup_dir": warm_dir,
                      "warmup_total_sec": round(sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
