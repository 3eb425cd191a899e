"""Run by test_leases: one of several drivers that land batches on the same path."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(lake: str, driver: int, batches: int, start: str) -> None:
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from cdclake import CdcConfig, ingest_batch

    fields = [{"type": "int64", "field": "id", "optional": True}]
    head = '{"schema":' + json.dumps({"type": "struct", "fields": fields}, separators=(",", ":")) + ',"payload":{"id":'
    cfg = CdcConfig(base_path=lake, lease_seconds=20, rows_per_file=None)
    open(f"{start}-{driver}", "w").close()
    while not all(os.path.exists(f"{start}-{k}") for k in (0, 1)):  # both drivers write at the same time
        time.sleep(0.05)
    for b in range(batches):
        low = (driver * batches + b) * 100
        ev = spark.range(low, low + 100, 1, 4).select(F.lit("t").alias("destination"), F.lit(None).cast("string").alias("key"), F.concat(F.lit(head), F.col("id").cast("string"), F.lit("}}")).alias("value"))
        ingest_batch(ev, cfg, batch_id=b, batch_time_ms=1)


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), int(sys.argv[3]), sys.argv[4])
