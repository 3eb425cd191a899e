"""Progress of streaming queries as rows: what each batch took, and what it left behind."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_DIR = "_progress"
PROGRESS_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("at", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("rows_per_second", T.DoubleType()),
    T.StructField("batch_ms", T.LongType()),
    T.StructField("backlog", T.LongType()),  # what the sources have beyond the batch's end, in their own units; null if they don't say
])


def backlog_of(source: dict) -> int | None:
    """How far a source's latest offset is ahead of the batch's end: offsets by partition (Kafka), or one number."""
    metrics = source.get("metrics") or {}
    end, latest = source.get("endOffset"), source.get("latestOffset")
    if isinstance(end, dict) and isinstance(latest, dict):
        ahead = [backlog_of({"endOffset": end.get(k), "latestOffset": v}) for k, v in latest.items()]
        known = [x for x in ahead if x is not None]
        if known:
            return sum(known)
    if isinstance(end, (int, float)) and isinstance(latest, (int, float)):
        return max(0, int(latest - end))
    for name in ("estimatedTotalBytesBehindLatest", "maxOffsetsBehindLatest", "numFilesOutstanding"):
        if name in metrics:
            return int(float(metrics[name]))
    return None


def progress_row(progress: dict) -> tuple:
    """A progress report (Spark's JSON) as a row of ``PROGRESS_SCHEMA``."""
    ahead = [x for x in map(backlog_of, progress.get("sources") or []) if x is not None]
    return (progress["id"], progress["batchId"], progress["timestamp"], progress.get("numInputRows") or 0, float(progress.get("processedRowsPerSecond") or 0.0),
            int((progress.get("durationMs") or {}).get("triggerExecution") or 0), sum(ahead) if ahead else None)


class ProgressLog(StreamingQueryListener):
    """Appends a row for each batch of the session's streaming queries to ``<base_path>/_progress``.

    ``spark.streams.addListener(ProgressLog(spark, base))``; triggers without rows are not logged.
    """

    def __init__(self, spark: SparkSession, base_path: str):
        self.spark, self.path = spark, f"{base_path.rstrip('/')}/{PROGRESS_DIR}"

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        if report.get("numInputRows"):
            self.spark.createDataFrame([progress_row(report)], PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
