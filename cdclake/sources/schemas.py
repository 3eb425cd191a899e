"""Persisted schemas of tables whose events carry none.

Each table's schema is a chain of versions under ``_schemas/<table>/<part>``;
a version is the join of all that was inferred before, in the lattice of widened types. A new one is
created under the next number, which fails if another writer was first; the join
is then made again with what that one stored. So versions only ever widen.
"""

from __future__ import annotations

import json
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .leases import create_new
from .manifest import file_system, relative_to
from .tables import as_version, widen_structs

SCHEMAS_DIR = "_schemas"
VERSION = "schema_version"  # folder level of a version's files
PAYLOAD, ROWS = "payload", "rows"  # what events hold; what is landed of them


def _folder(base_path: str, table: str, part: str) -> str:
    return f"{base_path.rstrip('/')}/{SCHEMAS_DIR}/{table}/{part}"


def _read(spark: SparkSession, path: str) -> T.StructType:
    fs, p = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    for _ in range(100):  # an empty file is being written
        if fs.getFileStatus(p).getLen():
            stream = fs.open(p)
            try:
                return T.StructType.fromJson(json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
        time.sleep(0.1)
    raise OSError(f"{path} is empty: its writer ended before it was written; delete it")


def stored_schema(spark: SparkSession, base_path: str, table: str, part: str = ROWS) -> tuple[int, T.StructType | None]:
    """(number of the newest version, its schema); (0, None) without one."""
    fs, folder = file_system(spark, _folder(base_path, table, part))
    if not fs.exists(folder):
        return 0, None
    numbers = [int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()]
    if not numbers:
        return 0, None
    return max(numbers), _read(spark, f"{_folder(base_path, table, part)}/{max(numbers):08d}")


def join_schema(spark: SparkSession, base_path: str, table: str, struct: T.StructType, part: str = PAYLOAD) -> tuple[int, T.StructType]:
    """(version, schema) of the join of the stored schema and ``struct``, stored if it is wider than before.

    Types that have no common one (a number and a text) raise with the column's name.
    """
    while True:
        number, known = stored_schema(spark, base_path, table, part)
        joined = widen_structs([known, struct] if known is not None else [struct])
        if joined == known:
            return number, joined
        if create_new(spark, f"{_folder(base_path, table, part)}/{number + 1:08d}", joined.json()):
            return number + 1, joined


def stored_versions(spark: SparkSession, base_path: str, table: str, part: str = ROWS) -> list[tuple[int, T.StructType]]:
    """All versions, oldest first."""
    newest, _ = stored_schema(spark, base_path, table, part)
    return [(n, _read(spark, f"{_folder(base_path, table, part)}/{n:08d}")) for n in range(1, newest + 1)]


def read_stored(spark: SparkSession, base_path: str, path: str, *, save_format: str = "parquet", options: dict[str, str] | None = None,
                provenance: str | None = None) -> DataFrame:
    """A table landed with ``CdcConfig.schema_store``: a scan for each schema version, each with its own types, widened and unioned by name.

    Files of version n lie in folders ``schema_version=n``; planning opens none.
    """
    versions = stored_versions(spark, base_path, relative_to(path, base_path))
    if not versions:
        raise ValueError(f"{path} has no stored schema under {base_path}")
    newest = versions[-1][1]
    scans = []
    for n, struct in versions:
        rows = spark.read.format(save_format).options(**(options or {})).schema(struct).load(path).where(F.col(VERSION) == n)
        named = [f.name for f in rows.schema.fields if f.name not in struct.fieldNames() and f.name != VERSION]
        kept = [*named, *([F.col("_metadata.file_path").alias(provenance)] if provenance else [])]
        scans.append(as_version(rows, struct, newest, kept))
    return reduce(DataFrame.unionByName, scans)
