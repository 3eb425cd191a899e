"""Reports over landed tables and the ingest log: file/batch sizes, batch-size
utilisation, lag and progress. All are aggregations or windows over small
per-batch logs, or single aggregations over the table scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import write_id

# Utilisation bands of the adaptive wait (lower bound, label,
# factor applied to the previous wait; None = keep it, "grow" = scale up).
UTILISATION_BANDS = (
    (0.97, ">=97%", 0.50),
    (0.95, ">=95%", 0.65),
    (0.90, ">=90%", 0.80),
    (0.85, ">=85%", None),
)
HISTORY_SEED = 1  # the three-slot history starts as 1, 1, 1


def batch_sizes(table: DataFrame, by: str = "file", *, file_col: str = "input_file") -> DataFrame:
    """Rows per output file (``by='file'``) or per write job (``by='write'``).

    The write id is the UUID Spark puts in every file name of one write job.
    """
    name = F.element_at(F.split(F.col(file_col), "/"), -1)
    key = name if by == "file" else write_id(name)
    return table.groupBy(key.alias(by)).agg(F.count(F.lit(1)).alias("rows"))


def batch_utilisation(log: DataFrame, max_batch_size: int, *, partition: str | None = "destination",
                      order: str = "batch_id", rows: str = "rows") -> DataFrame:
    """Average of the last three batch sizes (history seeded with 1s) vs ``max_batch_size``.

    A log has a row per schema group; a batch's rows are summed first, per
    ``partition``, or over the whole batch with ``partition=None`` (what the adaptive wait is told).

    ``band`` and ``wait_factor`` say what the adaptive wait would do next:
    shrink the wait (0.50/0.65/0.80), hold it, or grow it.
    """
    names = [partition] if partition else []
    log = log.groupBy(*names, order).agg(F.sum(rows).cast("bigint").alias(rows))
    w = Window.partitionBy(*names).orderBy(order)
    n = F.col(rows).cast("double")
    lag1 = F.coalesce(F.lag(F.col(rows), 1).over(w).cast("double"), F.lit(float(HISTORY_SEED)))
    lag2 = F.coalesce(F.lag(F.col(rows), 2).over(w).cast("double"), F.lit(float(HISTORY_SEED)))
    avg3 = (n + lag1 + lag2) / F.lit(3.0)
    util = avg3 / F.lit(float(max_batch_size))
    band: Column = F.lit("<85%")
    factor: Column = F.lit("grow")
    for lower, label, f in reversed(UTILISATION_BANDS):
        band = F.when(util >= lower, F.lit(label)).otherwise(band)
        factor = F.when(util >= lower, F.lit("hold" if f is None else f"{f:.2f}")).otherwise(factor)
    return log.select(*names, F.col(order), F.col(rows), avg3.alias("avg3"), util.alias("utilisation"),
                      band.alias("band"), factor.alias("wait_factor"))


def lag_report(df: DataFrame, batch_time_ms: int | Column, *, destination: str = "destination",
               source_ts_ms: str = "__source_ts_ms", op: str = "__op") -> DataFrame:
    """Per destination: rows, max/min milliseconds behind source, snapshot rows."""
    bt = batch_time_ms if isinstance(batch_time_ms, Column) else F.lit(int(batch_time_ms)).cast("bigint")
    lag = bt - F.col(source_ts_ms).cast("bigint")
    return df.groupBy(destination).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(lag).alias("max_lag_ms"),
        F.min(lag).alias("min_lag_ms"),
        F.count_if(F.col(op) == "r").alias("snapshot_rows"),
    )


def progress_report(log: DataFrame, *, partition: str = "destination", order: str = "batch_id",
                    rows: str = "rows") -> DataFrame:
    """Running total of landed rows per destination, batch by batch."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return log.select(F.col(partition), F.col(order), F.col(rows), F.sum(F.col(rows)).over(w).alias("running_total"))


def progress_by_interval(log: DataFrame, *, time_ms: str = "batch_time_ms", interval: str = "15 minutes",
                         partition: str = "destination", rows: str = "rows") -> DataFrame:
    """Rows landed per destination per fixed interval (the periodic progress line)."""
    t = F.timestamp_millis(F.col(time_ms).cast("bigint"))
    return log.groupBy(F.window(t, interval).alias("interval"), F.col(partition)).agg(F.sum(rows).alias("rows"))


def snapshot_state(changes: DataFrame, *, destination: str = "destination", batch: str = "batch_id", order: str = "__lsn", op: str = "__op") -> DataFrame:
    """Each destination's snapshots: snapshot (from 1), first_batch, last_batch, rows and state (``completed`` or ``running``).

    A snapshot is a run of snapshot reads (``op`` ``r``) over successive batches. It is completed once a change of another
    kind comes after its last read, in ``order`` within a batch or in a later batch, else it runs; so the
    next read begins another. The changes are summed per batch first, map-side,
    so a destination's window holds a row per batch, however many changes it has. Null ``order`` counts as the first.
    """
    read = F.col(op).eqNullSafe("r")
    at = F.coalesce(F.col(order).cast("bigint"), F.lit(-(2**63)).cast("bigint"))
    batches = changes.groupBy(F.col(destination).alias("destination"), F.col(batch).alias("batch")).agg(
        F.count_if(read).alias("reads"), F.max(F.when(read, at)).alias("last_read"), F.max(F.when(~read, at)).alias("last_other"))
    ends = F.coalesce(F.col("reads") == 0, F.lit(False)) | F.coalesce(F.col("last_other") > F.col("last_read"), F.lit(False))
    w = Window.partitionBy("destination").orderBy("batch")
    marked = batches.withColumn("ends", ends).withColumn("before", F.coalesce(F.lag("ends").over(w), F.lit(True)))
    runs = marked.withColumn("run", F.sum(F.col("before").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = runs.groupBy("destination", "run").agg(
        F.min(F.when(F.col("reads") > 0, F.col("batch"))).alias("first_batch"), F.max(F.when(F.col("reads") > 0, F.col("batch"))).alias("last_batch"),
        F.sum("reads").alias("rows"), F.bool_or("ends").alias("ended")).where("rows > 0")
    number = F.row_number().over(Window.partitionBy("destination").orderBy("run"))
    return found.select("destination", number.alias("snapshot"), "first_batch", "last_batch", "rows", F.when(F.col("ended"), F.lit("completed")).otherwise(F.lit("running")).alias("state"))
