"""Small-file compaction of a landed table partition (rows unchanged)."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.transform import quoted
from ..sources.manifest import BASENAME, Written, active_files, file_system, publish, relative_to
from ..sources.tables import widen_structs

# Fixed value: default size of a compacted file.
TARGET_FILE_BYTES = 512 * 1024 * 1024


@dataclass
class CompactResult:
    source_path: str
    target_path: str
    rows: int
    files_before: int
    files_after: int


def _hashable(c: Column, t: T.DataType) -> Column:
    """The column with its maps, at any depth, as entries in key order (maps themselves have no hash)."""
    if isinstance(t, T.MapType):
        entry = T.StructType([T.StructField("key", t.keyType), T.StructField("value", t.valueType)])
        keys = F.sort_array(F.map_keys(c)) if not isinstance(t.keyType, (T.StructType, T.MapType)) else F.map_keys(c)
        return F.transform(keys, lambda k: _hashable(F.struct(k.alias("key"), F.element_at(c, k).alias("value")), entry))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _hashable(x, t.elementType))
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_hashable(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))
    return c


def _fingerprint_cols(df: DataFrame) -> list[Column]:
    """Row count and an order-free content checksum (sum of row hashes)."""
    h = F.xxhash64(*[_hashable(quoted(f.name), f.dataType) for f in df.schema.fields]).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(h), F.lit(0)).alias("h")]


def _fingerprint(df: DataFrame) -> tuple[int, int]:
    r = df.select(*_fingerprint_cols(df)).first()
    return int(r["n"]), int(r["h"])


def _listing(spark: SparkSession, path: str) -> tuple[int, int]:
    files, size, _ = _listing_with_partitions(spark, path)
    return files, size


def _listing_with_partitions(spark: SparkSession, path: str) -> tuple[int, int, list[str]]:
    """(data files, bytes, partition columns) under ``path``: one listing, counted by a job that opens no file.

    Names starting with ``_`` or ``.`` (commit markers, summaries, checksums)
    are not data, as for Spark's file index. Partition columns are the
    ``name=value`` folder levels between ``path`` and the files (e.g. ``dt``).
    """
    fs, root = file_system(spark, path)
    base = fs.makeQualified(root).toString().rstrip("/")
    below = F.expr(f"substring(path, {len(base) + 2})")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(below.alias("rel"), "length")
              .where(~F.col("rel").rlike("(^|/)[_.]")))
    folders = F.filter(F.slice(F.split("rel", "/"), 1, F.size(F.split("rel", "/")) - 1), lambda x: x.contains("="))
    levels = F.transform(folders, lambda x: F.substring_index(x, "=", 1))
    found = listed.groupBy(levels.alias("levels")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("size")).limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"{path} holds files at different partition levels: {found[0]['levels']} and {found[1]['levels']}")
    return (found[0]["files"], found[0]["size"], found[0]["levels"]) if found else (0, 0, [])


def _hidden(name: str) -> str:
    """A folder name that reads of its parent skip: with an underscore first and no equals sign."""
    return "_" + name.lstrip("_").replace("=", "-")


def compact_partition(spark: SparkSession, path: str, *, save_format: str = "parquet", files: int | None = None,
                      rows_per_file: int | None = None, target_file_bytes: int = TARGET_FILE_BYTES,
                      target_path: str | None = None, verify: bool = True) -> CompactResult:
    """Rewrite the files under ``path`` into fewer, larger files at ``target_path``.

    The number of output files is ``files`` if given, else derived from
    ``rows_per_file`` (row count), else from the bytes on storage divided by
    ``target_file_bytes``; so a large partition still gets many writer tasks.
    Input partitions of small files are already packed by the scan
    (``spark.sql.files.maxPartitionBytes``); ``coalesce`` merges them into the
    output count without a shuffle. A table root with ``name=value`` folders
    (``dt=``) is rewritten with the same folders.

    The source is never overwritten in place: the result goes to a new path
    (default: a sibling ``_<name>.compacted-<id>``, which reads of the parent
    folder do not see). With ``verify`` the row
    count and content checksum of the source are observed during the write
    itself (one scan), then compared with one scan of the result;
    :func:`commit_compaction` swaps the result in.
    """
    files_before, bytes_before, partition_cols = _listing_with_partitions(spark, path)
    src = spark.read.format(save_format).option("mergeSchema", "true").load(path)
    if files is None:
        if rows_per_file:
            files = max(1, math.ceil(src.count() / rows_per_file))
        else:
            files = max(1, math.ceil(bytes_before / target_file_bytes))
    parent, _, name = path.rstrip("/").rpartition("/")
    out = target_path or f"{parent}/{_hidden(name)}.compacted-{uuid.uuid4().hex[:8]}"
    obs = Observation(f"compact_{uuid.uuid4().hex}")
    data = src.observe(obs, *_fingerprint_cols(src))
    if partition_cols:
        # By folder, large ones split and small ones merged at run time: no task writes a file into every folder.
        data = data.hint("rebalance", *partition_cols)
    elif files < src.rdd.getNumPartitions():
        data = data.coalesce(files)
    writer = data.write.mode("errorifexists").format(save_format)
    if partition_cols:
        # A table root with ``dt=`` (or other) folders keeps its layout.
        writer = writer.partitionBy(*partition_cols)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.save(out)
    seen = obs.get
    before = (int(seen["n"]), int(seen["h"]))
    if verify:
        after = _fingerprint(spark.read.format(save_format).option("mergeSchema", "true").load(out))
        if after != before:
            raise RuntimeError(f"compaction changed the data of {path}: {before} -> {after}")
    return CompactResult(path, out, before[0], files_before, _listing(spark, out)[0])


def commit_compaction(spark: SparkSession, result: CompactResult) -> str:
    """Put the compacted files in the place of the source; returns where the source went.

    Two renames on the table's file system: the source to a hidden sibling
    (``_<name>.retired-<id>``), then the result to the source's path. A crash
    between them leaves the table away but complete in both hidden folders: calling this again
    finishes the swap. Writers of the path must be stopped meanwhile; deleting the retired
    folder is left to the caller, once no reader uses it.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    parent, _, name = result.source_path.rstrip("/").rpartition("/")
    tag = result.target_path.rsplit("-", 1)[-1]
    source, target, retired = (hadoop.Path(x) for x in (result.source_path, result.target_path, f"{parent}/{_hidden(name)}.retired-{tag}"))
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise FileNotFoundError(f"{result.target_path} is not there: committed already?")
    if not fs.exists(retired) and not fs.rename(source, retired):
        raise OSError(f"cannot move {result.source_path}")
    if not fs.rename(target, source):
        raise OSError(f"cannot move {result.target_path}")
    return retired.toString()


def bins_of(sizes: dict[str, int], target_file_bytes: int) -> list[list[str]]:
    """Small files of one folder packed into outputs of at most ``target_file_bytes``: each into the first that has room, the largest first."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        for k, (used, names) in enumerate(bins):
            if used + size <= target_file_bytes:
                bins[k] = (used + size, names + [name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


@dataclass
class CompactPlan:
    """What :func:`compact_published` did: files that went, files that came, files left as they are, rows rewritten."""

    removed: int
    added: int
    untouched: int
    rows: int


def compact_published(spark: SparkSession, base_path: str, table_path: str, *, target_file_bytes: int = TARGET_FILE_BYTES,
                      small_file_bytes: int | None = None, save_format: str = "parquet") -> CompactPlan:
    """Rewrite the small files of a published table, over all its folders, by one job; large files stay.

    Files under ``small_file_bytes`` (half the target by default) are packed, folder by
    folder, into outputs of at most ``target_file_bytes``; an output of a single file is left alone. The sizes
    come from the manifest, whose rows are all that the driver holds. The new files are
    written beside the old ones; one published batch then adds the new and removes the old,
    so readers by the manifest see the table before or after, at any time. If the rows that were
    written differ from those logged, nothing is published. :func:`cdclake.sources.manifest.delete_removed` deletes old files.
    """
    small_file_bytes = small_file_bytes or target_file_bytes // 2
    active = active_files(spark, base_path, table_path).persist()
    try:
        folders: dict[str, dict[str, int]] = {}
        files = 0
        for r in active.select("file", "bytes").toLocalIterator():
            files += 1
            if r["bytes"] < small_file_bytes:
                folders.setdefault(r["file"].rpartition("/")[0], {})[r["file"]] = r["bytes"]
        packed = [names for folder in sorted(folders) for names in bins_of(folders[folder], target_file_bytes)]
        if not packed:
            return CompactPlan(0, 0, files, 0)
        root = table_path.rstrip("/")
        chosen = spark.createDataFrame([(name, k) for k, names in enumerate(packed) for name in names], "file string, bin int")
        old = active.join(chosen.select("file"), "file", "left_semi")
        schema = widen_structs([T.StructType.fromJson(json.loads(r[0])) for r in old.groupBy("schema_json").agg(F.min("min_ts_ms").alias("ts")).orderBy("ts").select("schema_json").toLocalIterator()])
        partition_cols = [part.split("=", 1)[0] for part in packed[0][0].split("/")[:-1] if "=" in part]
        rows = spark.read.format(save_format).schema(schema).option("basePath", root).load([f"{root}/{name}" for names in packed for name in names])
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        bins = chosen.select(F.element_at(F.split("file", "/"), -1).alias("__name"), F.col("bin").alias("__bin"))
        dealt = rows.withColumn("__name", name).join(bins, "__name").drop("__name").repartitionById(len(packed), F.col("__bin")).drop("__bin")
        tag, obs = f"c{uuid.uuid4().hex[:12]}", Observation(f"compact_{uuid.uuid4().hex}")
        writer = dealt.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(save_format).option(BASENAME, tag)
        (writer.partitionBy(*partition_cols) if partition_cols else writer).save(root)
        wanted, found = old.agg(F.sum("rows")).first()[0], int(obs.get["rows"])
        if wanted != found:
            raise RuntimeError(f"compaction of {root} wrote {found} rows of {wanted}; nothing was published")
        new = publish(spark, base_path, f"compact-{tag}", [Written(relative_to(root, base_path), root, schema.json(), tag)], save_format=save_format, removed=old)
        removed = sum(len(names) for names in packed)
        return CompactPlan(removed, new.where("not removed").count(), files - removed, found)
    finally:
        active.unpersist()
