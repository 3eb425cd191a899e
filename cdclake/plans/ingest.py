"""Micro-batch ingest: split a batch of change events by destination and schema
version, decode each group with its own schema and append it to the table path.

Plan of one batch::

    events ─ drop_tombstones ─ include_tables ─ key (gid = hash(destination, schema text, kind))
           ─ sortWithinPartitions(gid, destination) ─ persist           (no shuffle)
           ─ groupBy(gid, destination, kind, schema text).count()     (hash agg, map-side; one row per group)
           ─ per group: filter(gid) ─ from_json(T) ─ enrich ─ observe(count) ─ write

``from_json`` needs a constant schema, so a loop over the distinct schema
groups is inherent; it is bounded by tables x live schema versions (checked
against ``max_groups``). Sorting the cached batch by ``gid`` inside each
partition makes every group's scan skip the cached column batches of other
groups, and a group holding most rows is still spread over all partitions.
"""

from __future__ import annotations

import hashlib
import math
import re
import threading
import time
import uuid
import weakref
from collections import Counter, OrderedDict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby

from pyspark import SparkContext, StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CdcConfig, default_parallelism, scratch_path
from ..functions.columns import map_destination, partition_date_text, target_path_text
from ..functions.schema import SOURCE_TS_MS, canonical_schema, connect_schema_to_struct
from ..operators.decode import CORRUPT, decode_payload, infer_payload_schema
from ..operators.envelope import (KIND_DECLARED, KIND_ENVELOPED_NO_SCHEMA, KIND_MALFORMED,
                                  drop_tombstones, event_kind, include_tables, malformed_flag, schema_text)
from ..functions.logical import logical_signature, with_logical_types
from ..operators.mongo import decode_documents
from ..sources.leases import PathLease
from ..sources.schemas import ROWS, VERSION, join_schema
from ..sources.manifest import BASENAME, Written, is_published, publish, read_manifest, relative_to
from ..operators.transform import HEADERS, add_headers, add_source_ts, cast_deleted, snapshot_as_insert, unwrap


class _PathLock:
    """A lock that can be weakly referenced, so that the table of locks holds live ones only."""

    def __init__(self) -> None:
        self.lock = threading.Lock()

    def __enter__(self) -> "_PathLock":
        self.lock.acquire()
        return self

    def __exit__(self, *exc: object) -> None:
        self.lock.release()


# Serialise writes per target path across threads and concurrent batches.
_PATH_LOCKS: "weakref.WeakValueDictionary[str, _PathLock]" = weakref.WeakValueDictionary()
_PATH_LOCKS_GUARD = threading.Lock()

QUARANTINE_DIR = "_quarantine"
INGEST_LOG_DIR = "_ingest_log"
BATCH_TIMES_DIR = "_batch_times"


def _path_lock(path: str) -> _PathLock:
    with _PATH_LOCKS_GUARD:
        return _PATH_LOCKS.setdefault(path, _PathLock())


@contextmanager
def _writing(df: DataFrame, path: str, cfg: CdcConfig) -> Iterator[None]:
    """Alone on a path: within this process, and with ``cfg.lease_seconds`` between drivers, too."""
    with _path_lock(path):
        if not cfg.lease_seconds:
            yield
            return
        with PathLease(df.sparkSession, cfg.base_path, path, seconds=cfg.lease_seconds):
            yield


@dataclass
class SchemaGroup:
    """Events of one destination that decode with one Spark schema."""

    destination: str
    kind: int
    gids: list[int]
    rows: int
    struct: T.StructType | None
    schema_text: str | None = None
    exact_texts: list[str | None] | None = None  # set when two schemas share one 64-bit key
    size: int = 0  # bytes of the events as held; 0: unknown

    @property
    def enveloped(self) -> bool:
        return self.kind in (KIND_DECLARED, KIND_ENVELOPED_NO_SCHEMA)

    def condition(self):
        cond = F.col("gid").isin(self.gids)
        if self.exact_texts is not None:
            same = [F.col(SCHEMA_COL).eqNullSafe(F.lit(t)) for t in self.exact_texts]
            cond = cond & (F.col("destination") == F.lit(self.destination)) & (F.col("kind") == self.kind) & reduce(Column.__or__, same)
        return cond


@dataclass
class GroupResult:
    destination: str
    path: str
    rows: int
    n_fields: int
    schema_hash: str
    kind: int
    schema_json: str = ""


@dataclass
class BatchResult:
    batch_id: int | None
    batch_time_ms: int
    groups: list[GroupResult] = field(default_factory=list)
    staged_groups: int = 0  # small groups read from the staged table (see stage_small_groups)
    tag: str | None = None  # what the names of the batch's files begin with, if it is published by a manifest
    written: list[Written] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(g.rows for g in self.groups if g.kind != KIND_MALFORMED)


SCHEMA_COL = "__schema"
BARE = "__bare"  # true: the value was '{"schema":<__schema>,"payload":...}' and is held without its schema

# Bytes of held events that one writing task reads, at most; and of a group's events whose typed rows are still
# dealt anew so that their files come out full.
TASK_BYTES = 512 * 1024 * 1024
DEAL_BYTES = 4 * 1024 * 1024 * 1024


def key_events(events: DataFrame, check_malformed: bool = False) -> DataFrame:
    """Add ``__schema``, ``kind`` and ``gid`` (64-bit hash of destination, schema and kind).

    ``__schema`` is the embedded schema as the JSON parser prints it, so blanks,
    the order of an event's members and further members do not matter: events of all
    producers are keyed by one rule. Storing it is cheap, as a group's rows
    have one value of it (a dictionary entry in the cache and in Parquet).
    ``check_malformed`` also takes events for malformed that have text after their end.
    """
    kind = event_kind("value", F.col(SCHEMA_COL))
    if check_malformed:
        kind = F.when(malformed_flag("value"), F.lit(KIND_MALFORMED)).otherwise(kind)
    extra = [HEADERS] if HEADERS in events.columns else []
    return (events.select("destination", "key", "value", *extra, schema_text("value").alias(SCHEMA_COL))
            .select("*", kind.alias("kind"))
            .withColumn("gid", F.xxhash64("destination", SCHEMA_COL, "kind")))


def _from_byte(at: Column) -> Column:
    """The value from a byte on, counted from 1: to cut by characters, Spark would count those of the whole text."""
    return F.substring(F.col("value").cast("binary"), at, F.lit(2**31 - 1)).cast("string")


def bare_values(keyed: DataFrame) -> DataFrame:
    """Keyed events without the schema text in their values: ``__schema`` has it already, once a group.

    Only a value that begins with just that text is cut, so :func:`whole_value` gives back every value as it came.
    """
    head = F.concat(F.lit('{"schema":'), F.col(SCHEMA_COL), F.lit(',"payload":'))
    bare = F.coalesce((F.col("kind") == KIND_DECLARED) & F.startswith(F.col("value"), head), F.lit(False))
    value = F.when(F.col(BARE), F.concat(F.lit('{"payload":'), _from_byte(F.octet_length(SCHEMA_COL) + len('{"schema":,"payload":') + 1))).otherwise(F.col("value"))
    return keyed.withColumn(BARE, bare).withColumn("value", value)


def whole_value() -> Column:
    """The value of a row of :func:`bare_values` as it came."""
    return F.when(F.col(BARE), F.concat(F.lit('{"schema":'), F.col(SCHEMA_COL), F.lit(","), _from_byte(F.lit(2)))).otherwise(F.col("value")).alias("value")


def keyed_events(events: DataFrame, cfg: CdcConfig) -> DataFrame:
    """Events as a batch holds them: keyed, without the schema in their values, and with their own keys only if bad ones are kept."""
    keyed = bare_values(key_events(events, check_malformed=cfg.on_malformed == "quarantine"))
    return keyed.drop("key") if cfg.on_malformed == "fail" else keyed


# How many of the first events are looked at, and the tables of a partition that is written without a shuffle, at most.
FIRST_ROWS, FEW_TABLES = 1000, 4


def holds_few_tables(events: DataFrame) -> bool:
    """Whether partitions hold events of few tables each, as of a snapshot or of topics; told by the first events.

    Frames with shuffles other than dealing by number aren't looked at: their shuffles would run twice.
    """
    plan = events._jdf.queryExecution().executedPlan().toString()
    if plan.count("Exchange") > plan.count("Exchange RoundRobinPartitioning"):
        return False
    found = set(map(tuple, events.select(F.spark_partition_id(), "destination").take(FIRST_ROWS)))
    return all(n <= FEW_TABLES for n in Counter(part for part, _ in found).values())


def input_partitions(df: DataFrame) -> int | None:
    """Partitions of a frame that reads files or topics without a shuffle; None if only a run could tell.

    Asking a frame with a shuffle for its partitions runs the shuffle.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return None if "Exchange" in plan else df.rdd.getNumPartitions()


def dealt_partitions(df: DataFrame) -> int:
    """Partitions that a frame was dealt into by number after its last shuffles; 0 if it wasn't."""
    dealt, below = 0, None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if below is not None and depth > below:
            continue
        below = depth if "Exchange" in line else None
        if found := re.search(r"Exchange RoundRobinPartitioning\((\d+)\)", line):
            dealt = max(dealt, int(found[1]))
    return dealt


def spread(events: DataFrame, min_partitions: int | None, rebalance: str = "auto") -> DataFrame:
    """Round-robin a batch over the task slots before decoding.

    Decoding is CPU-bound; a Kafka topic with few partitions or a few large
    files would otherwise decode on a handful of cores. Round-robin keeps
    every partition the same size whatever the table mix (no hot keys) and
    is deterministic on retry. ``auto`` spreads only inputs with fewer
    partitions than slots; ``always`` also evens out a wide but skewed input
    (a hot topic partition) at the price of one shuffle of the batch;
    ``never`` keeps the input partitioning.
    """
    if rebalance not in ("auto", "always", "never"):
        raise ValueError(f"rebalance must be auto, always or never, not {rebalance!r}")
    if rebalance == "never":
        return events
    n = min_partitions or default_parallelism(events.sparkSession)
    p = input_partitions(events)
    if p is None:  # shuffled already: as wide as it was dealt, or as the session's shuffles, which run-time planning may narrow
        p = max(dealt_partitions(events), int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if rebalance == "always":
        return events.repartition(max(n, p))
    return events.repartition(n) if p < n else events


def group_counts(keyed: DataFrame, sizes: bool = False) -> DataFrame:
    """One row per (gid, destination, kind, schema) with its row count; ``sizes`` adds the bytes of its values.

    The schema text is the same for every row of a gid, so it can be a
    grouping key: the only aggregation buffer left is a count, which lets
    Spark use a hash aggregate that combines map-side and needs no sort of
    the batch. The shuffle carries one row per group per partition holding
    the schema text only, never a payload.
    """
    return (keyed.groupBy("gid", "destination", "kind", F.col(SCHEMA_COL).alias("sample"))
            .agg(F.count(F.lit(1)).alias("rows"), *([F.sum(F.octet_length("value")).alias("size")] if sizes else [])))


def group_rounds(keyed: DataFrame, max_groups: int, logical: bool = False, sizes: bool = False) -> Iterator[list[SchemaGroup]]:
    """The (destination, schema) groups of a keyed batch, about ``max_groups`` at a time.

    Group counts are sorted by key and come to the driver partition by
    partition; a batch with more groups than ``max_groups`` is landed in
    several rounds. A destination's groups whose schemas compile to the same Spark type are
    merged (they differ only in names, versions or optional flags); with ``logical``, if their logical types are the same too.
    """
    rows = group_counts(keyed, sizes).orderBy("destination", "gid", "kind", "sample").toLocalIterator()
    held: list = []
    for _, same in groupby(rows, key=lambda r: (r["destination"], r["gid"])):
        held += same
        if len(held) >= max_groups:
            yield _compiled(held, logical)
            held = []
    if held:
        yield _compiled(held, logical)


def discover_groups(keyed: DataFrame, max_groups: int, logical: bool = False) -> list[SchemaGroup]:
    """All groups of ``group_rounds``."""
    return [g for groups in group_rounds(keyed, max_groups, logical) for g in groups]


def _compiled(found: list, logical: bool = False) -> list[SchemaGroup]:
    """Groups of the rows of :func:`group_counts`; all rows of one key must be among them."""
    shared = {gid for gid, n in Counter(r["gid"] for r in found).items() if n > 1}
    merged: "OrderedDict[tuple, SchemaGroup]" = OrderedDict()
    for r in found:
        dest, kind, text = r["destination"], r["kind"], r["sample"]
        if dest is None:
            raise ValueError("destination cannot be null")
        struct = canon = None
        if kind == KIND_DECLARED:
            try:
                struct, canon = connect_schema_to_struct(text), canonical_schema(text)
                canon = (canon, logical_signature(text)) if logical else canon
            except (ValueError, TypeError, KeyError, AttributeError) as e:
                raise ValueError(f"malformed change event for destination {dest!r}: {e}") from e
        exact = [text] if r["gid"] in shared else None
        k = (dest, kind, canon, r["gid"] if exact else None, text if exact else None)
        size = (r["size"] or 0) if "size" in r else 0
        if k in merged:
            merged[k].gids.append(r["gid"])
            merged[k].rows += r["rows"]
            merged[k].size += size
        else:
            merged[k] = SchemaGroup(dest, kind, [r["gid"]], r["rows"], struct, text if kind == KIND_DECLARED else None, exact, size)
    return list(merged.values())


DESTINATION = "__destination"


def decode_group(keyed: DataFrame, group: SchemaGroup, cfg: CdcConfig, batch_time_ms: int,
                 only_group: bool = False, with_destination: bool = False) -> DataFrame:
    """Typed, enriched rows of one group (``only_group``: the frame holds nothing else).

    ``with_destination`` keeps each row's destination as ``__destination``.

    A field that does not fit its type is null, as in the reference. With
    ``on_malformed="quarantine"`` such rows are left out here and land in the
    quarantine (:func:`misfits`).
    """
    rows = keyed if only_group else keyed.filter(group.condition())
    extra = (HEADERS,) if cfg.header_fields and HEADERS in rows.columns else ()
    if with_destination:
        rows = rows.withColumn(DESTINATION, F.col("destination"))
        extra += (DESTINATION,)
    strict = cfg.on_malformed == "quarantine"
    if group.kind != KIND_DECLARED and group.struct is None:
        group.struct = infer_payload_schema(rows, enveloped=group.enveloped)
        if cfg.schema_store and cfg.base_path:
            _, group.struct = join_schema(rows.sparkSession, cfg.base_path, table_name(cfg, group.destination), group.struct)
    has_ts = SOURCE_TS_MS in group.struct.fieldNames()
    if has_ts:  # only rows whose time is null are parsed for whether they have the field
        payload = F.get_json_object("value", "$.payload") if group.enveloped else F.col("value")
        rows = rows.withColumn("__payload", payload)
        extra += ("__payload",)
    df = decode_payload(rows, group.struct, enveloped=group.enveloped, corrupt=strict, keep=extra)
    if strict:
        df = df.filter(~F.col(CORRUPT)).drop(CORRUPT)
    if cfg.logical_types and group.schema_text is not None:
        df = with_logical_types(df, group.schema_text)
    present = F.col(SOURCE_TS_MS).isNotNull() | F.array_contains(F.json_object_keys("__payload"), SOURCE_TS_MS) if has_ts else None
    if cfg.unwrap and {"op", "source"} <= set(df.columns) and ({"after", "before"} & set(df.columns)):
        if isinstance(df.schema["after" if "after" in df.columns else "before"].dataType, T.StringType):
            df = decode_documents(df)  # images as JSON text
        df = unwrap(df, cfg.add_fields, keep=tuple(c for c in extra if c in df.columns))
    if cfg.snapshot_as_insert and "__op" in df.columns:
        df = snapshot_as_insert(df)
    df = add_source_ts(df, batch_time_ms, legacy_null_ts=cfg.legacy_null_ts, present=present)
    if has_ts:
        df = df.drop("__payload")
    if cfg.cast_deleted_field:
        df = cast_deleted(df)
    if cfg.header_fields:
        df = add_headers(df, cfg.header_fields)
    return df


def misfits(keyed: DataFrame, group: SchemaGroup) -> DataFrame:
    """The events of a group with a field that does not fit its type, as text."""
    rows = keyed.filter(group.condition())
    held = (SCHEMA_COL, BARE) if BARE in rows.columns else ()
    bad = decode_payload(rows, group.struct, enveloped=group.enveloped, corrupt=True, keep=("destination", "key", "value", *held)).filter(CORRUPT)
    return bad.select("destination", "key", whole_value() if held else "value")


SHARED_COLUMN = "destination"  # folder level of the tables of shared writes


def group_path(cfg: CdcConfig, destination: str, batch_time_ms: int) -> str:
    dt = partition_date_text(batch_time_ms, cfg.partition_tz) if cfg.partition else None
    if cfg.shared_writes:
        base, name = cfg.base_path.rstrip("/"), target_path_text(destination, "", cfg.prefix, cfg.dest_regexp, cfg.dest_replace)[1:]
        escape = SparkContext._active_spark_context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{base}/{SHARED_COLUMN}={escape(name)}" + (f"/{dt}" if dt else "")
    return target_path_text(destination, cfg.base_path, cfg.prefix, cfg.dest_regexp, cfg.dest_replace, dt)


def shared_groups(groups: list[SchemaGroup], logical: bool = False) -> list[list[SchemaGroup]]:
    """Groups that one job can decode and write: those with one declared schema, whatever their destinations."""
    found: "OrderedDict[object, list[SchemaGroup]]" = OrderedDict()
    for k, g in enumerate(groups):
        alike = g.kind == KIND_DECLARED and g.exact_texts is None
        found.setdefault((g.kind, g.struct.json(), logical_signature(g.schema_text) if logical else None) if alike else k, []).append(g)
    return list(found.values())


def table_name(cfg: CdcConfig, destination: str) -> str:
    """A destination's table, relative to the lake's base path."""
    return relative_to(group_path(cfg.with_(partition=False), destination, 0), cfg.base_path)


def write_shared(df: DataFrame, cfg: CdcConfig, batch_time_ms: int, basename: str | None = None) -> int:
    """Append rows of many destinations (``__destination``) to ``base/destination=<name>[/dt=...]`` by one job.

    Rows are dealt by destination: run-time planning splits a hot one and merges small ones, so files
    follow rows, not destinations x tasks.
    """
    folders = [SHARED_COLUMN] + (["dt"] if cfg.partition else [])
    if clash := sorted(set(folders) & set(df.columns)):
        raise ValueError(f"shared writes need the names {folders} for folders, but rows have {clash}")
    if cfg.save_mode != "append":
        raise ValueError("shared writes append: any other mode would act on all tables of the lake")
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    name = F.concat(F.lit(cfg.prefix), map_destination(DESTINATION, cfg.dest_regexp, cfg.dest_replace))
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")).withColumn(SHARED_COLUMN, name).drop(DESTINATION)
    if cfg.partition:
        out = out.withColumn("dt", F.lit(partition_date_text(batch_time_ms, cfg.partition_tz).split("=", 1)[1]))
    writer = out.hint("rebalance", SHARED_COLUMN).write.mode("append").format(cfg.save_format).options(**dict(cfg.write_options)).partitionBy(*folders)
    if cfg.rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(cfg.rows_per_file))
    if basename:
        writer = writer.option(BASENAME, basename)
    with _writing(df, f"{cfg.base_path.rstrip('/')}/{SHARED_COLUMN}", cfg):
        writer.save(cfg.base_path)
    return int(obs.get.get("rows", 0))


def write_group(df: DataFrame, path: str, cfg: CdcConfig, expected_rows: int | None = None, basename: str | None = None,
                size: int = 0, scanned: int = 0) -> int:
    """Append ``df`` to ``path``; the row count is observed during the write itself. Names of its files begin with ``basename``.

    ``size``: bytes of the group's events; ``scanned``: bytes that all tasks read to get them (the whole cached batch).
    No task gets more than about ``TASK_BYTES`` of either, so a few files more are left if rows are large.
    """
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if cfg.rows_per_file and expected_rows:
        # Files of ``rows_per_file`` rows (``maxRecordsPerFile`` caps every file;
        # each task leaves at most one partial file, so there are never more than 2n):
        # - more tasks than files: merge partitions without a shuffle;
        # - a few more files than tasks (n <= 2p): most files would be partial,
        #   so deal the rows round-robin into exactly n tasks, if their events
        #   have no more than ``DEAL_BYTES``: else that shuffle would take more disk than the table;
        # - many more files than tasks: each task writes its own rows in full
        #   files, no shuffle (a partial file per task is at most 1/3 of files);
        # - a group that is a small part of a large cached batch: merged tasks would
        #   each read much of the cache, so there are up to 2n of them, or if these are too few its typed rows are dealt into n tasks.
        n = max(1, math.ceil(expected_rows / cfg.rows_per_file), math.ceil(size / TASK_BYTES))
        p = out.rdd.getNumPartitions()
        if n < p:
            tasks = max(n, math.ceil(scanned / (2 * TASK_BYTES)))
            out = out.coalesce(tasks) if tasks <= 2 * n else out.repartition(n)
        elif p < n <= 2 * p and size <= DEAL_BYTES:
            out = out.repartition(n)
    writer = out.write.mode(cfg.save_mode).format(cfg.save_format).options(**dict(cfg.write_options))
    if cfg.rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(cfg.rows_per_file))
    if cfg.summary_metadata and cfg.save_format == "parquet":
        writer = writer.option("parquet.summary.metadata.level", "ALL")
    if basename:
        writer = writer.option(BASENAME, basename)
    with _writing(df, path, cfg):
        writer.save(path)
    return int(obs.get.get("rows", 0))


def replay_dir(path: str, stream_id: str, batch_id: int, group: SchemaGroup) -> str:
    """Directory of one (stream, batch, schema group) under ``path`` in idempotent mode.

    Derived from the stream's identity, the batch id and the group's schema
    hash only, so a replay of the same batch (same offsets, same events) writes to the
    same place and no other stream does. The letters before the hex texts
    keep them from being read back as numbers.
    """
    tag = f"g{group.gids[0] & 0xFFFFFFFFFFFFFFFF:016x}"
    if group.exact_texts:
        tag += "-" + hashlib.sha1(str(group.exact_texts[0]).encode()).hexdigest()[:16]
    return f"{path}/stream_id=s{stream_id}/batch_id={batch_id}/group={tag}"


def stable_batch_time(spark, base_path: str, stream_id: str, batch_id: int, proposed_ms: int) -> int:
    """The batch time recorded by the first attempt of a stream's ``batch_id``, else ``proposed_ms`` (recorded now).

    Keeps ``dt=`` folders and default source times of a replayed batch equal
    to those of the first attempt. One small file per batch id on the lake's
    file system, written under another name and renamed, so a crash leaves no
    half record; an empty file counts as none. No Spark job.
    """
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    folder = f"{base_path.rstrip('/')}/{BATCH_TIMES_DIR}/{stream_id}"
    p = hadoop.Path(f"{folder}/{batch_id}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p) or not fs.getFileStatus(p).getLen():
        draft = hadoop.Path(f"{folder}/.{batch_id}.{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.writeBytes(str(int(proposed_ms)))
        out.close()
        if fs.exists(p) and not fs.getFileStatus(p).getLen():
            fs.delete(p, False)
        if fs.rename(draft, p):
            return int(proposed_ms)
        fs.delete(draft, False)  # recorded meanwhile: that record holds
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return int(reader.readLine())
    finally:
        reader.close()


def small_groups(groups: list[SchemaGroup], partitions: int, cfg: CdcConfig) -> list[SchemaGroup]:
    """Groups worth staging: small ones, when together they would launch too many tasks.

    Each group's job scans the cached batch with one task per partition, so
    G groups cost G x P tasks even when most groups hold a few rows (the
    usual CDC batch: a few hot tables, many quiet ones).
    """
    small = [g for g in groups if g.kind != KIND_MALFORMED and g.rows <= cfg.small_group_rows]
    return small if len(small) > 1 and len(small) * partitions > cfg.max_group_tasks else []


def stage_small_groups(keyed: DataFrame, small: list[SchemaGroup]) -> tuple[DataFrame, str]:
    """Write the rows of ``small`` once, partitioned by group id, to the shared scratch folder.

    One job, whose shuffle moves the small groups' rows only; afterwards each small
    group's scan prunes to its own folder and needs only a few tasks. The
    staged rows live on shared storage, so they also survive executor loss.
    """
    spark = keyed.sparkSession
    path = scratch_path(spark, "ingest_small_groups")
    gids = sorted({x for g in small for x in g.gids})
    # Dealt by group, small ones merged and large ones split at run time: files follow rows, not groups x partitions.
    keyed.filter(F.col("gid").isin(gids)).hint("rebalance", "gid").write.partitionBy("gid").parquet(path)
    return spark.read.schema(keyed.schema).parquet(path), path


# Fixed value: a staged table is so many times smaller than its events, as it is compressed.
STAGED_SHARE = 6


def stage_batch(keyed: DataFrame, few_tables: bool = False) -> tuple[DataFrame, str]:
    """Write a keyed batch once to the shared scratch folder, partitioned by group id.

    One job: rows are dealt by group, and run-time planning splits a hot group
    and merges small ones, so files follow rows, not groups x partitions.
    ``few_tables``: each partition holds few groups (:func:`holds_few_tables`), so it is written as it is and
    the batch isn't shuffled.
    Within a file the schema is one repeated value, which Parquet's
    dictionary encoding stores almost for free, so discovery reads only small
    columns. Every group then prunes to its own folder.
    """
    spark = keyed.sparkSession
    path = scratch_path(spark, "ingest_batch")
    rows = keyed if few_tables else keyed.hint("rebalance", "gid")
    rows.write.partitionBy("gid").option("compression", "zstd").parquet(path)
    return spark.read.schema(keyed.schema).parquet(path), path


def _delete(spark, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _bytes_of(spark, path: str) -> int:
    """Bytes of the files under a folder; 0 if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def _cached_bytes(keyed: DataFrame) -> int:
    """Bytes of a cached frame that a job has read whole."""
    return int(keyed._jdf.queryExecution().withCachedData().stats().sizeInBytes())


def _schema_hash(struct: T.StructType | None) -> str:
    return hashlib.sha1((struct.json() if struct is not None else "").encode()).hexdigest()[:16]


def ingest_batch(events: DataFrame, cfg: CdcConfig, batch_id: int | None = None,
                 batch_time_ms: int | None = None, stream_id: str | None = None) -> BatchResult:
    """Land one batch of change events; returns per-group written row counts.

    Writes are serial per destination (schema groups in order) and parallel
    across destinations (``cfg.parallel_writes`` threads, each a Spark job).
    The batch is acknowledged by the caller only after this returns, so a
    failure replays the whole batch: at-least-once, like the reference.
    With ``cfg.idempotent`` every (stream, batch, schema group) is written with
    overwrite to its own :func:`replay_dir` and the batch time of the first
    attempt is reused, so a replayed batch id replaces its output: the
    landed rows are exactly-once. ``stream_id`` names whose batch ids these
    are (``cfg.stream_id`` if not given; a streaming query's own id by default).
    A batch of more than ``cfg.max_groups`` groups is landed in rounds.
    With ``cfg.manifest`` all tables' files are published together once the last of them is written; a
    batch that fails before shows none of its rows to readers by the manifest, and one that is published already is not landed again.
    With ``cfg.shared_writes`` destinations with one schema are decoded and written by one job.
    With ``cfg.lease_seconds`` each write holds the lease of its path; one that lost it to another driver fails the batch.
    """
    spark = events.sparkSession
    batch_time_ms = int(batch_time_ms if batch_time_ms is not None else time.time() * 1000)
    if cfg.idempotent:
        if batch_id is None:
            raise ValueError("idempotent writes need a batch id")
        stream_id = stream_id or cfg.stream_id
        if not stream_id or not re.fullmatch(r"[A-Za-z0-9._-]+", stream_id):
            raise ValueError("idempotent writes need a stream id of letters, digits, dots and dashes: batch ids of two streams are alike")
        batch_time_ms = stable_batch_time(spark, cfg.base_path, stream_id, batch_id, batch_time_ms)
    if cfg.idempotent and (cfg.manifest or cfg.shared_writes):
        raise ValueError("idempotent folders exclude a manifest, which lands each batch once too, and shared writes")
    if cfg.schema_store and cfg.shared_writes:
        raise ValueError("a schema store keeps each table's versions in folders of their own, which shared writes don't")
    wcfg = cfg.with_(save_mode="overwrite") if cfg.idempotent else cfg
    result = BatchResult(batch_id, batch_time_ms)
    key = None
    if cfg.manifest:
        if cfg.save_format not in ("parquet", "orc"):
            raise ValueError("a manifest needs Parquet or ORC tables")
        stream_id = stream_id or cfg.stream_id
        if batch_id is not None and not re.fullmatch(r"[A-Za-z0-9._-]+", stream_id or ""):
            raise ValueError("published batches need a stream id of letters, digits, dots and dashes: batch ids of two streams are alike")
        key = f"{stream_id}-{batch_id}" if batch_id is not None else uuid.uuid4().hex
        if is_published(spark, cfg.base_path, key):
            return _published_result(spark, cfg, key, result)
        result.tag = f"b{uuid.uuid4().hex[:12]}"
    ev = drop_tombstones(events)
    if cfg.include_tables is not None:
        ev = include_tables(ev, cfg.include_tables)
    dealt = spread(ev, cfg.min_partitions, cfg.rebalance)
    if cfg.batch_storage not in ("cache", "table"):
        raise ValueError(f"batch_storage must be cache or table, not {cfg.batch_storage!r}")
    keyed = keyed_events(dealt, cfg)
    batch_path = None
    if cfg.batch_storage == "table":
        keyed, batch_path = stage_batch(keyed, dealt is ev and holds_few_tables(events))
    else:
        keyed = keyed.sortWithinPartitions("gid", "destination").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for groups in group_rounds(keyed, cfg.max_groups, cfg.logical_types, sizes=batch_path is None):
            _land_round(keyed, groups, cfg, wcfg, result, stream_id, batch_path)
    finally:
        if batch_path is None:
            keyed.unpersist()
        else:
            _delete(spark, batch_path)
    if key is not None:
        publish(spark, cfg.base_path, key, result.written, save_format=cfg.save_format)
    if cfg.ingest_log and result.groups:
        append_ingest_log(spark, cfg, result, stream_id)
    return result


def _published_result(spark, cfg: CdcConfig, key: str, result: BatchResult) -> BatchResult:
    """What a batch that is published already landed, per table."""
    rows = read_manifest(spark, cfg.base_path).where(F.col("batch") == key).groupBy("table").agg(F.sum("rows").alias("rows"), F.min("schema_json").alias("schema"))
    for r in rows.toLocalIterator():
        result.groups.append(GroupResult(r["table"], f"{cfg.base_path.rstrip('/')}/{r['table']}", r["rows"], 0, "", KIND_DECLARED, r["schema"]))
    return result


def _land_round(keyed: DataFrame, groups: list[SchemaGroup], cfg: CdcConfig, wcfg: CdcConfig, result: BatchResult,
                stream_id: str | None, batch_path: str | None) -> None:
    """Decode and write some groups of a keyed batch, cached or staged at ``batch_path``; their results are added to ``result``."""
    batch_id, batch_time_ms = result.batch_id, result.batch_time_ms
    cached = _cached_bytes(keyed) if batch_path is None else 0
    small = [] if batch_path is not None or cfg.shared_writes else small_groups(groups, keyed.rdd.getNumPartitions(), cfg)
    staged, staged_path = stage_small_groups(keyed, small) if small else (None, None)
    result.staged_groups += len(small)
    small_ids = {id(g) for g in small}
    by_dest: "OrderedDict[str, list[SchemaGroup]]" = OrderedDict()
    for g in groups:
        by_dest.setdefault(g.destination, []).append(g)

    def quarantine(bad: DataFrame, g: SchemaGroup) -> GroupResult:
        path = f"{cfg.base_path.rstrip('/')}/{QUARANTINE_DIR}/{g.destination}"
        if cfg.idempotent:
            path = replay_dir(path, stream_id, batch_id, g)
        rows = bad.select("destination", "key", "value", F.lit(batch_time_ms).cast("bigint").alias("batch_time_ms"))
        n = write_group(rows, path, wcfg.with_(save_format="json", rows_per_file=None))
        return GroupResult(g.destination, path, n, 0, "", KIND_MALFORMED)

    def next_tag() -> str | None:
        return None if result.tag is None else f"{result.tag}{uuid.uuid4().hex[:8]}"  # one for each write

    def note(dest: str, path: str, schema_json: str, tag: str | None) -> None:
        if tag is not None:
            result.written.append(Written(table_name(cfg, dest), path, schema_json, tag))

    def land_shared(members: list[SchemaGroup]) -> list[GroupResult]:
        g = SchemaGroup(members[0].destination, members[0].kind, [x for m in members for x in m.gids], sum(m.rows for m in members), members[0].struct, members[0].schema_text, members[0].exact_texts)
        df = decode_group(keyed, g, cfg, batch_time_ms, with_destination=True)
        tag = next_tag()
        total = write_shared(df, cfg, batch_time_ms, tag)
        schema_json = df.drop(DESTINATION).schema.json()
        lost: dict[str, int] = {}
        out = []
        if cfg.on_malformed == "quarantine" and total < g.rows:
            bad = misfits(keyed, g)
            lost = {r["destination"]: r["count"] for r in bad.groupBy("destination").count().toLocalIterator()}
            out += [quarantine(bad.filter(F.col("destination") == m.destination), m) for m in members if m.destination in lost]
        rows = Counter()
        for m in members:
            rows[m.destination] += m.rows
        for dest, n in rows.items():
            path = group_path(cfg, dest, batch_time_ms)
            out.append(GroupResult(dest, path, n - lost.get(dest, 0), len(df.columns) - 1, _schema_hash(g.struct), g.kind, schema_json))
            note(dest, path, schema_json, tag)
        return out

    def land(dest: str) -> list[GroupResult]:
        out = []
        for g in by_dest[dest]:
            if g.kind == KIND_MALFORMED:
                if cfg.on_malformed == "fail":
                    raise ValueError(f"{g.rows} malformed change events for destination {dest!r}")
                out.append(quarantine(keyed.filter(g.condition()), g))  # malformed values are held whole
                continue
            source = staged if id(g) in small_ids else keyed
            df = decode_group(source, g, cfg, batch_time_ms)
            path = group_path(cfg, dest, batch_time_ms)
            if cfg.schema_store and g.kind != KIND_DECLARED:
                version, _ = join_schema(keyed.sparkSession, cfg.base_path, table_name(cfg, dest), df.schema, ROWS)
                path = f"{path}/{VERSION}={version}"
            if cfg.idempotent:
                path = replay_dir(path, stream_id, batch_id, g)
            tag = next_tag()
            if batch_path is not None:
                g.size = STAGED_SHARE * sum(_bytes_of(keyed.sparkSession, f"{batch_path}/gid={x}") for x in g.gids)
            n = write_group(df, path, wcfg, g.rows, tag, g.size, 0 if id(g) in small_ids else cached)
            out.append(GroupResult(dest, path, n, len(df.columns), _schema_hash(g.struct), g.kind, df.schema.json()))
            note(dest, path, df.schema.json(), tag)
            if cfg.on_malformed == "quarantine" and n < g.rows:
                bad = misfits(source, g)
                if bad.limit(1).count():
                    out.append(quarantine(bad, g))
        return out

    jobs = [(land, dest) for dest in by_dest]
    if cfg.shared_writes:
        good = [g for g in groups if g.kind != KIND_MALFORMED]
        by_dest = OrderedDict((d, [g for g in gs if g.kind == KIND_MALFORMED]) for d, gs in by_dest.items())
        jobs = [(land, d) for d, gs in by_dest.items() if gs] + [(land_shared, m) for m in shared_groups(good, cfg.logical_types)]
    try:
        if cfg.parallel_writes > 1 and len(jobs) > 1:
            with ThreadPoolExecutor(max_workers=min(cfg.parallel_writes, len(jobs))) as pool:
                for res in pool.map(lambda job: job[0](job[1]), jobs):
                    result.groups.extend(res)
        else:
            for run, of in jobs:
                result.groups.extend(run(of))
    finally:
        if staged_path is not None:
            _delete(keyed.sparkSession, staged_path)


class DecodedGroups(list):
    """(group, typed frame) pairs; as a context manager it deletes their staged table when left."""

    def __init__(self, spark, path: str | None) -> None:
        super().__init__()
        self.spark, self.path = spark, path

    def close(self) -> None:
        """Delete the staged table: the frames can't be read any more."""
        if self.path is not None:
            _delete(self.spark, self.path)
            self.path = None

    def __enter__(self) -> "DecodedGroups":
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()


def decode_events(events: DataFrame, cfg: CdcConfig | None = None, batch_time_ms: int = 0,
                  materialize: bool = True) -> DecodedGroups:
    """Decode a frame of events without writing: one typed frame per schema group.

    With ``materialize`` the keyed events are first written once to a table
    in the shared scratch folder (``spark.checkpoint.dir``), partitioned by
    group id (see :func:`stage_batch`). Discovery then reads only the
    stored schema samples, and each group frame reads only its own folder
    (partition pruning): the input is read and keyed once, and lineage is
    cut there, which also keeps executor loss cheap. Without it, discovery
    and every group frame recompute the input. Each returned frame is lazy;
    the table stays in the scratch folder until :meth:`DecodedGroups.close`.
    """
    cfg = cfg or CdcConfig(base_path="")
    ev = drop_tombstones(events)
    if cfg.include_tables is not None:
        ev = include_tables(ev, cfg.include_tables)
    dealt = spread(ev, cfg.min_partitions, cfg.rebalance)
    keyed = keyed_events(dealt, cfg)
    path = None
    if materialize:
        keyed, path = stage_batch(keyed, dealt is ev and holds_few_tables(events))
    groups = discover_groups(keyed, cfg.max_groups, cfg.logical_types)
    out = DecodedGroups(events.sparkSession, path)
    for g in groups:
        if g.kind == KIND_MALFORMED:
            if cfg.on_malformed == "fail":
                raise ValueError(f"{g.rows} malformed events for destination {g.destination!r}")
            continue
        out.append((g, decode_group(keyed, g, cfg, batch_time_ms, only_group=len(groups) == 1)))
    return out


INGEST_LOG_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("batch_time_ms", T.LongType()),
    T.StructField("destination", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("n_fields", T.IntegerType()),
    T.StructField("schema_hash", T.StringType()),
    T.StructField("kind", T.IntegerType()),
    T.StructField("schema_json", T.StringType()),
])


def append_ingest_log(spark, cfg: CdcConfig, result: BatchResult, stream_id: str | None = None) -> None:
    """One row per written group (bounded by the group count) to ``base/_ingest_log``."""
    rows = [(result.batch_id, result.batch_time_ms, g.destination, g.path, g.rows, g.n_fields, g.schema_hash, g.kind,
             g.schema_json) for g in result.groups]
    log = f"{cfg.base_path.rstrip('/')}/{INGEST_LOG_DIR}"
    df = spark.createDataFrame(rows, INGEST_LOG_SCHEMA).coalesce(1)
    if cfg.idempotent:
        # One folder per stream and batch id, replaced by a replay; read back as columns.
        df.write.mode("overwrite").parquet(f"{log}/log_stream=s{stream_id}/log_batch={result.batch_id}")
    else:
        with _writing(df, log, cfg):  # a path that all batches of the lake append to
            df.write.mode("append").parquet(log)


__all__ = ["BatchResult", "GroupResult", "SchemaGroup", "append_ingest_log", "decode_events", "decode_group", "discover_groups", "group_counts",
           "group_path", "group_rounds", "ingest_batch", "input_partitions", "key_events", "misfits", "replay_dir", "shared_groups", "small_groups", "stable_batch_time", "stage_batch", "stage_small_groups", "spread", "write_group", "write_shared"]
