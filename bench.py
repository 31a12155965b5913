"""Benchmark: run every registered query on $BENCH_SF_DIR and print one JSON
line with per-query wall-clock seconds.

Each query is executed in full with the ``noop`` sink (all rows computed, none
shipped to the driver). Before timing, every query runs once on the smallest
data set (untimed JVM/codegen warm-up), so the first timed join does not pay
the one-off start-up cost.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def stream_times(spark, sf_dir: str) -> dict:
    """Streaming apps over the same data: the raw log lines are written once
    (untimed) as JSON files into a fresh scratch folder, then each app
    consumes them with ``availableNow`` (4 files per micro-batch) and the
    wall clock of the whole run is reported."""
    import tempfile

    from pyspark.sql import functions as F

    from shopflow import fixtures as fx
    from shopflow.sources import streams
    from shopflow.sources.tables import Tables
    from shopflow.streaming import apps

    out = {}
    scratch = tempfile.mkdtemp(prefix="shopflow-bench-", dir=os.environ.get("BENCH_SCRATCH"))
    raw = fx.raw_log_json(Tables(spark, sf_dir).events)
    for kind in ("startup", "event"):
        (raw.filter(F.col("kind") == kind).select("value").repartition(16)
         .write.text(os.path.join(scratch, kind)))
    runs = {
        "stream_dau_app": lambda: apps.dau_app(
            streams.text_files(spark, os.path.join(scratch, "startup"), 4),
            os.path.join(scratch, "dau_out"), trigger={"availableNow": True},
            checkpoint=os.path.join(scratch, "ck_dau")),
        "stream_alert_app": lambda: apps.alert_app(
            streams.text_files(spark, os.path.join(scratch, "event"), 4),
            os.path.join(scratch, "alert_out"), "4 hours", "1 hour", "1 hour",
            trigger={"availableNow": True}, checkpoint=os.path.join(scratch, "ck_alert")),
    }
    for name, start in runs.items():
        t0 = time.perf_counter()
        start().awaitTermination()  # raises if the stream failed
        out[name] = round(time.perf_counter() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    import shopflow.app_queries  # noqa: F401  registers its queries
    from shopflow.catalog import QUERIES
    from shopflow.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="shopflow-bench")
    names = only or sorted(QUERIES)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:   # warm-up, not timed
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        times[name] = round(run(name), 3)
    if not only and os.environ.get("BENCH_STREAMS", "1") == "1":
        times.update(stream_times(spark, sf_dir))

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
