"""Intermediate tables in the cluster's shared scratch folder (``spark.checkpoint.dir``).

A written table cuts lineage: a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """One operator call's folder; ``drop`` deletes a table that no later result reads.

    Results may read the rest as long as the application runs; when it ends the folder goes.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, name)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table; the write's shuffle files go when it ends."""
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in names:
            path = hadoop.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
