"""Read-back of landed tables: merged schema plus file provenance."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: name of the provenance column.
INPUT_FILE = "input_file"

# Numeric widening order used when schema versions disagree.
_NUMERIC_RANK = {"IntegerType": 1, "LongType": 2, "FloatType": 3, "DoubleType": 4}


def widen_types(a: T.DataType, b: T.DataType, path: str = "") -> T.DataType:
    """Smallest type both versions of a column read into (numeric widening, struct union)."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ra, rb = _NUMERIC_RANK.get(type(a).__name__), _NUMERIC_RANK.get(type(b).__name__)
    if ra and rb:
        if {ra, rb} == {2, 3}:  # bigint and float meet in double
            return T.DoubleType()
        return a if ra > rb else b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widen_structs([a, b], path)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen_types(a.elementType, b.elementType, path + "[]"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widen_types(a.keyType, b.keyType, path + "{}"),
                         widen_types(a.valueType, b.valueType, path + "{}"), True)
    raise ValueError(f"column {path or '?'}: {a.simpleString()} and {b.simpleString()} cannot be read as one type")


def widen_structs(structs: list[T.StructType], path: str = "") -> T.StructType:
    """Union of struct versions by field name, in first-seen order, types widened."""
    fields: dict[str, T.DataType] = {}
    for st in structs:
        for f in st.fields:
            name = f"{path}.{f.name}" if path else f.name
            fields[f.name] = widen_types(fields[f.name], f.dataType, name) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of an older version as the widened type: numbers cast, missing fields of structs null."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        names = have.fieldNames()
        fields = [(as_type(c.getField(f.name), have[f.name].dataType, f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(c, lambda _, x: as_type(x, have.valueType, want.valueType))
    return c.cast(want)


def as_version(df: DataFrame, have: T.StructType, want: T.StructType, kept: Sequence[str | Column] = ()) -> DataFrame:
    """Rows read with an older version's schema as the widened one's columns, and ``kept`` ones."""
    names = have.fieldNames()
    quoted = lambda x: F.col("`" + x.replace("`", "``") + "`")
    cols = [as_type(quoted(f.name), have[f.name].dataType, f.dataType).alias(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields]
    return df.select(*cols, *kept)


def logged_schemas(spark: SparkSession, ingest_log: str, path: str) -> list[T.StructType]:
    """Distinct written schemas of a table (one per version, from the ingest log).

    The log has a fixed schema, so it is read without opening its footers.
    """
    from ..plans.ingest import INGEST_LOG_SCHEMA

    root = path.rstrip("/")
    log = spark.read.schema(INGEST_LOG_SCHEMA).parquet(ingest_log)
    rows = (log.filter((F.col("path") == root) | F.col("path").startswith(root + "/"))
            .filter(F.col("schema_json").isNotNull())
            .groupBy("schema_json").agg(F.min("batch_time_ms").alias("first_seen"))
            .orderBy("first_seen").toLocalIterator())
    return [T.StructType.fromJson(json.loads(r["schema_json"])) for r in rows]


def logged_rows(spark: SparkSession, ingest_log: str, path: str) -> int:
    """Rows that the logged batches of a table wrote."""
    from ..plans.ingest import INGEST_LOG_SCHEMA

    root = path.rstrip("/")
    log = spark.read.schema(INGEST_LOG_SCHEMA).parquet(ingest_log)
    return log.filter((F.col("path") == root) | F.col("path").startswith(root + "/")).agg(F.sum("rows")).first()[0] or 0


def read_table(spark: SparkSession, path: str, *, save_format: str = "parquet", merge_schema: bool = True,
               provenance: bool = True, ingest_log: str | None = None,
               options: dict[str, str] | None = None, manifest: str | None = None, uncovered: str = "hide",
               schema_store: str | None = None) -> DataFrame:
    """Scan a landed table directory.

    With ``manifest`` (the lake's base path, of batches landed with ``CdcConfig.manifest``) the scan is
    planned from the published files alone, see :func:`cdclake.sources.manifest.read_published`.
    With ``schema_store`` (the lake's base path, of batches landed with ``CdcConfig.schema_store``) a table of
    events without schemas is read by its stored schema versions: no file is opened to plan, and older files are widened.

    Files written under different schema versions are merged by name (new
    columns appear, missing ones are null). Reading the table root (not
    ``root/*``) keeps ``dt=`` directories as a prunable ``dt`` column.
    ``input_file`` carries each row's source file.

    Without ``ingest_log`` the merge reads every file's footer (Parquet/ORC),
    or infers the schema from all the data (JSON): a job that grows with the
    table. With ``ingest_log`` the schema is the union of the versions logged
    for this table (one row per version). The same path also reads versions that disagree on a
    column's type (``int`` then ``bigint``), where Spark's merge fails: the
    union is widened and the reader widens the older files. The log must
    cover the table: its rows are counted (footers in Parquet and ORC, data in
    other formats) and compared with the logged ones. If they differ, as after a batch
    landed without the log, the footers' columns are added, and formats without
    footers raise. ``options`` go to the reader (e.g. ``header`` for CSV).
    """
    opts = dict(options or {})
    if manifest is not None:
        from .manifest import read_published

        return read_published(spark, manifest, path, uncovered=uncovered, save_format=save_format, options=opts, provenance=INPUT_FILE if provenance else None)
    if schema_store is not None:
        from .schemas import read_stored

        return read_stored(spark, schema_store, path, save_format=save_format, options=opts, provenance=INPUT_FILE if provenance else None)
    if ingest_log is not None and merge_schema:
        versions = logged_schemas(spark, ingest_log, path)
        if versions:
            df = spark.read.format(save_format).options(**opts).schema(widen_structs(versions)).load(path)
            found, logged = df.count(), logged_rows(spark, ingest_log, path)
            if found != logged:
                if save_format not in ("parquet", "orc"):
                    raise ValueError(f"{path} has {found} rows, its ingest log {logged}: columns that the log lacks would be lost; read without ingest_log")
                footers = spark.read.format(save_format).options(**opts).option("mergeSchema", "true").load(path).schema
                df = spark.read.format(save_format).options(**opts).schema(widen_structs([*versions, footers])).load(path)
            return df.withColumn(INPUT_FILE, F.col("_metadata.file_path")) if provenance else df
    reader = spark.read.format(save_format).options(**opts)
    if save_format in ("parquet", "orc"):
        reader = reader.option("mergeSchema", str(merge_schema).lower())
    df = reader.load(path)
    if provenance:
        df = df.withColumn(INPUT_FILE, F.col("_metadata.file_path"))
    return df


# Marker and summary files written at job commit.
COMMIT_FILES = ("_SUCCESS", "_metadata", "_common_metadata")


def commit_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Sizes of the commit marker and Parquet summary files present under ``path``.

    Spark's file index hides names starting with ``_``, so this asks the
    Hadoop file system of the session directly (a few ``exists`` calls on the
    driver; works for any Hadoop-supported URI).
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    found = {}
    for name in COMMIT_FILES:
        p = jvm.org.apache.hadoop.fs.Path(root, name)
        if fs.exists(p):
            found[name] = int(fs.getFileStatus(p).getLen())
    return found
