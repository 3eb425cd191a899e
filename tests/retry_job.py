"""Run by test_task_retries: land a batch while the first attempt of every input task fails."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(lake: str, ckpt: str) -> None:
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", ckpt).config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from cdclake import CdcConfig, ingest_batch, read_table

    @F.udf("string")
    def flaky(v):  # test-only fault injection: the first attempt of each input task dies mid-partition
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and v.endswith(("id\":7}}", "id\":1007}}", "id\":2007}}",
                                                                        "id\":3007}}")):
            raise RuntimeError("injected task failure")
        return v

    fields = [{"type": "int64", "field": "id", "optional": True}]
    head = '{"schema":' + json.dumps({"type": "struct", "fields": fields}, separators=(",", ":")) + ',"payload":{"id":'
    ev = (spark.range(0, 4000, 1, 4)
          .select(F.concat(F.lit("t.db."), F.when(F.col("id") % 3 == 0, "a").otherwise("b")).alias("destination"),
                  F.lit(None).cast("string").alias("key"),
                  F.concat(F.lit(head), F.col("id").cast("string"), F.lit("}}")).alias("value")))
    res = ingest_batch(ev.withColumn("value", flaky("value")), CdcConfig(base_path=lake, rows_per_file=300),
                       batch_id=0, batch_time_ms=1)
    t = read_table(spark, f"{lake}/t.db.a").unionByName(read_table(spark, f"{lake}/t.db.b"))
    tracker = spark.sparkContext.statusTracker()
    failed = sum(st.numFailedTasks for j in tracker.getJobIdsForGroup(None) if tracker.getJobInfo(j)
                 for s in tracker.getJobInfo(j).stageIds if (st := tracker.getStageInfo(s)) is not None)
    print(json.dumps({"rows": res.rows, "landed": t.count(), "distinct": t.select("id").distinct().count(),
                      "failed_tasks": failed}))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
