"""Benchmark: land change events and run the headline queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_EVENT_LOG (optional
folder: Spark's event log for stage and task times, instead of the UI, which stays off).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Setup (untimed): lineitem and orders are encoded as change events and written
as JSON-lines files, as a CDC producer would deliver them. Timed: landing those
files (read -> split by schema -> decode -> enrich -> write Parquet), and the
registered headline queries, each consumed in full through the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("cdclake-bench")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.files.maxPartitionBytes", os.environ.get("BENCH_MAX_PARTITION_BYTES", "32m")))
    if os.environ.get("BENCH_EVENT_LOG"):
        os.makedirs(os.environ["BENCH_EVENT_LOG"], exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", os.environ["BENCH_EVENT_LOG"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from cdclake import CdcConfig, ingest_batch, read_events, scratch_path
    from cdclake.sources.encode import encode_events
    from cdclake.sources.events import write_events
    from cdclake.workloads import QUERIES, op_rule, orders_events, source_rows

    li = source_rows(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    li_events = encode_events(li, "testc.inventory.lineitem", key=["l_orderkey", "l_linenumber"], op=op_rule(k),
                              lsn=k)
    src = scratch_path(spark, "bench_events")
    write_events(li_events.unionByName(orders_events(spark, sf_dir)), src)
    n_events = spark.read.json(src, schema="destination string").count()

    # Untimed warm-up on a small scale: JIT and class loading of the decode and write paths.
    warm = scratch_path(spark, "bench_warm")
    warm_dir = "/root/testdata/sf0.01" if os.path.exists("/root/testdata/sf0.01") else sf_dir
    write_events(orders_events(spark, warm_dir), warm)
    ingest_batch(read_events(spark, warm), CdcConfig(base_path=scratch_path(spark, "bench_warm_lake")), batch_id=0)

    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)

    def land_files():
        cfg = CdcConfig(base_path=scratch_path(spark, "bench_lake"), partition=True)
        res = ingest_batch(read_events(spark, src), cfg, batch_id=0)
        assert res.rows == n_events, (res.rows, n_events)

    timed("land_event_files", land_files)
    for name in ("ingest_roundtrip", "decode_declared", "unwrap_rewrite", "decode_inferred", "normalize_source",
                 "write_read_merge", "stream_ingest", "quarantine_ingest", "compact_partition", "lag_report",
                 "batch_utilisation", "land_texts", "land_vectors", "land_database", "land_backfill"):
        timed(name, lambda n=name: QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = round(sum(timings.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "land_events": n_events,
        "land_events_per_sec": round(n_events / timings["land_event_files"], 1),
        "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
