"""File manifest of landed tables: which files a batch wrote, made visible all at once.

A published batch is one folder ``_manifest/batch=<key>`` with a row per
written file; it appears by one rename after all tables of the batch were
written. Readers that go by the manifest see all of a batch or nothing, plan
their scan without opening a file, and see a compaction's files change hands at once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import SOURCE_TS_MS

MANIFEST_DIR = "_manifest"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),  # relative to the lake's base path
    T.StructField("file", T.StringType()),  # relative to the table
    T.StructField("bytes", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("min_ts_ms", T.LongType()),
    T.StructField("max_ts_ms", T.LongType()),
    T.StructField("schema_json", T.StringType()),
    T.StructField("removed", T.BooleanType()),
    T.StructField("batch", T.StringType()),
])
BASENAME = "mapreduce.output.basename"  # Spark's option for the first part of a written file's name


@dataclass
class Written:
    """A path that a batch wrote files to: files of table ``table`` whose names begin with ``tag``."""

    table: str
    path: str
    schema_json: str
    tag: str


def file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files under ``path``, relative to it, with their bytes: one recursive listing, no file is opened.

    Names that begin with ``_`` or ``.`` are no data, as for Spark's file index.
    """
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return {}
    base = fs.getFileStatus(root).getPath().toUri().getPath().rstrip("/")
    found, it = {}, fs.listFiles(root, True)
    while it.hasNext():
        status = it.next()
        relative = status.getPath().toUri().getPath()[len(base) :].strip("/")
        if not any(part.startswith(("_", ".")) for part in relative.split("/")):
            found[relative] = int(status.getLen())
    return found


def relative_to(path: str, base_path: str) -> str:
    base = base_path.rstrip("/")
    if not path.startswith(base + "/"):
        raise ValueError(f"{path} is not under {base}")
    return path[len(base) + 1 :].rstrip("/")


def read_manifest(spark: SparkSession, base_path: str) -> DataFrame:
    """All rows of all published batches (none if nothing is published)."""
    path = f"{base_path.rstrip('/')}/{MANIFEST_DIR}"
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def is_published(spark: SparkSession, base_path: str, key: str) -> bool:
    fs, p = file_system(spark, f"{base_path.rstrip('/')}/{MANIFEST_DIR}/batch={key}")
    return fs.exists(p)


def _file_rows(spark: SparkSession, base_path: str, written: list[Written], save_format: str) -> DataFrame:
    """A manifest row per file that ``written`` names; rows and times are read by one job over these files only."""
    base, found = base_path.rstrip("/"), []
    for w in written:
        table = f"{base}/{w.table}"
        inner = w.path.rstrip("/")[len(table) :].strip("/")
        for name, size in list_files(spark, w.path).items():
            if name.rsplit("/", 1)[-1].startswith(w.tag):
                found.append((w.table, f"{inner}/{name}" if inner else name, size, w.schema_json))
    files = spark.createDataFrame(found, "table string, file string, bytes bigint, schema_json string")
    if not found:
        return files.select("*", *[F.lit(None).cast("bigint").alias(x) for x in ("rows", "min_ts_ms", "max_ts_ms")], F.lit(False).alias("removed"))
    paths = [f"{base}/{table}/{name}" for table, name, _, _ in found]
    data = spark.read.format(save_format).schema(T.StructType([T.StructField(SOURCE_TS_MS, T.LongType())])).load(paths)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    counts = data.groupBy(name.alias("name")).agg(F.count("*").alias("rows"), F.min(SOURCE_TS_MS).alias("min_ts_ms"), F.max(SOURCE_TS_MS).alias("max_ts_ms"))
    files = files.withColumn("name", F.element_at(F.split("file", "/"), -1))
    return files.join(counts, "name", "left").select("table", "file", "bytes", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "min_ts_ms", "max_ts_ms", "schema_json", F.lit(False).alias("removed"))


def publish(spark: SparkSession, base_path: str, key: str, written: list[Written], *, save_format: str = "parquet", removed: DataFrame | None = None) -> DataFrame:
    """Make the files of ``written`` visible, and those of ``removed`` (manifest rows) invisible, all at once.

    The rows are written to a hidden folder, which one rename turns into the published batch. Publishing a key again
    is an error: its batch is there already.
    """
    root = f"{base_path.rstrip('/')}/{MANIFEST_DIR}"
    draft, target = f"{root}/_draft-{uuid.uuid4().hex}", f"{root}/batch={key}"
    rows = _file_rows(spark, base_path, written, save_format)
    if removed is not None:
        rows = rows.unionByName(removed.select("table", "file", "bytes", "rows", "min_ts_ms", "max_ts_ms", "schema_json", F.lit(True).alias("removed")))
    rows.coalesce(1).write.parquet(draft)
    fs, source = file_system(spark, draft)
    if is_published(spark, base_path, key) or not fs.rename(source, file_system(spark, target)[1]):
        raise FileExistsError(f"batch {key!r} is published already")
    return read_manifest(spark, base_path).where(F.col("batch") == key)


def active_files(spark: SparkSession, base_path: str, table_path: str) -> DataFrame:
    """Manifest rows of a table's files that were published and not removed since, one per file."""
    rows = read_manifest(spark, base_path).where(F.col("table") == relative_to(table_path, base_path))
    one = F.min(F.struct("bytes", "rows", "min_ts_ms", "max_ts_ms", "schema_json", "batch")).alias("one")
    return rows.groupBy("table", "file").agg(F.bool_or("removed").alias("gone"), one).where("not gone").select("table", "file", "one.*")


def read_published(spark: SparkSession, base_path: str, table_path: str, *, uncovered: str = "hide", save_format: str = "parquet", options: dict[str, str] | None = None,
                   provenance: str | None = None) -> DataFrame:
    """A table by its manifest: the published files' rows under the union of their logged schemas.

    A listing is held against the manifest. Files that no published batch
    names (a batch under way or failed, or landed without a manifest) are left out; with
    ``uncovered="read"`` they are read too, and only their footers are opened for their columns.
    Published files that were deleted are left out. Planning opens no published file. ``provenance`` names a column for each row's file.
    """
    from .tables import as_version, widen_structs

    if uncovered not in ("hide", "read"):
        raise ValueError(f"uncovered must be hide or read, not {uncovered!r}")
    root = table_path.rstrip("/")
    listed = list_files(spark, root)
    ever = read_manifest(spark, base_path).where(F.col("table") == relative_to(table_path, base_path))
    named = {r["file"] for r in ever.select("file").distinct().toLocalIterator()}
    active = active_files(spark, base_path, table_path)
    by_version: dict[str, list[str]] = {}
    for r in active.select("file", "schema_json").toLocalIterator():
        if r["file"] in listed:
            by_version.setdefault(r["schema_json"], []).append(r["file"])
    first = active.groupBy("schema_json").agg(F.min("batch").alias("batch"), F.min("min_ts_ms").alias("ts")).orderBy("ts", "batch")
    versions = {r["schema_json"]: T.StructType.fromJson(json.loads(r["schema_json"])) for r in first.toLocalIterator()}
    reader = lambda: spark.read.format(save_format).options(**(options or {})).option("basePath", root)
    scans = [(versions[x], sorted(by_version[x])) for x in versions if x in by_version]
    others = sorted(set(listed) - named) if uncovered == "read" else []
    if others:
        footers = reader().option("mergeSchema", "true").load([f"{root}/{x}" for x in others]).schema
        folders = {part.split("=", 1)[0] for x in others for part in x.split("/")[:-1] if "=" in part}
        scans.append((T.StructType([f for f in footers.fields if f.name not in folders]), others))
    schema = widen_structs([*versions.values(), *[x for x, _ in scans[-1:] if others]])
    # Files whose columns have the union's types already are one scan; each version with a narrower type is one of its own.
    same = lambda have: all(f.dataType == schema[f.name].dataType for f in have.fields)
    whole = [x for have, files in scans if same(have) for x in files]
    scans = ([(schema, whole)] if whole else []) + [(have, files) for have, files in scans if not same(have)]
    if not scans:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(provenance, F.lit(None).cast("string")) if provenance else empty
    out = []
    for have, files in scans:
        df = reader().schema(have).load([f"{root}/{x}" for x in files])
        folders = [c for c in df.columns if c not in have.fieldNames()]
        out.append(as_version(df, have, schema, [*folders, *([F.col("_metadata.file_path").alias(provenance)] if provenance else [])]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def delete_removed(spark: SparkSession, base_path: str, table_path: str) -> int:
    """Delete a table's files that a published batch removed (once no reader uses them); returns how many."""
    rows = read_manifest(spark, base_path).where(F.col("table") == relative_to(table_path, base_path))
    gone = rows.groupBy("file").agg(F.bool_or("removed").alias("gone")).where("gone")
    deleted = 0
    for r in gone.select("file").toLocalIterator():
        fs, p = file_system(spark, f"{table_path.rstrip('/')}/{r['file']}")
        deleted += int(fs.delete(p, False))
    return deleted
