"""Configuration: sink options, trigger policies and the shared scratch folder.

The sink options mirror the keys a CDC sink user sets (format, mode, path
mapping, partitioning, delete-marker cast). Spark settings themselves live on
the caller's ``SparkSession``; :func:`config_subset` only helps to lift a
prefixed group of properties out of a flat property map.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field, replace
from typing import Any, Mapping

from pyspark.sql import SparkSession

# Default fields copied out of the envelope when flattening.
DEFAULT_ADD_FIELDS = ("op", "table", "lsn", "source.ts_ms")
# Property prefixes of the sink and of the batching options.
SINK_PREFIX = "debezium.sink.sparkbatch."
BATCH_PREFIX = "debezium.sink.batch."
SOURCE_PREFIX = "debezium.source."
HEADERS_KEY = "debezium.transforms.unwrap.add.headers"


def config_subset(props: Mapping[str, Any], prefix: str) -> dict[str, str]:
    """Return the entries of ``props`` whose key starts with ``prefix``, prefix removed."""
    return {k[len(prefix):]: str(v) for k, v in props.items() if k.startswith(prefix) and len(k) > len(prefix)}


def _bool(v: Any) -> bool:
    return str(v).strip().lower() in ("1", "true", "yes", "on")


@dataclass(frozen=True)
class TriggerPolicy:
    """How a streaming query admits data into a micro-batch.

    ``NoBatchSizeWait``: take whatever is available, immediately.
    ``MaxBatchSizeWait``: wait until ``max_batch_size`` events are queued or
    ``max_wait_ms`` elapsed; expressed as source admission options
    (``minOffsetsPerTrigger``/``maxTriggerDelay``/``maxOffsetsPerTrigger`` for
    Kafka, ``maxFilesPerTrigger`` plus a processing-time trigger for files;
    JSON-lines files read with the query's checkpoint location end batches at exactly
    ``max_batch_size`` rows, and do not wait while a snapshot runs).
    ``DynamicBatchSizeWait``: kept for name compatibility; behaves like
    ``MaxBatchSizeWait`` for admission, and its utilisation bands are a report
    (:func:`cdclake.operators.reports.batch_utilisation`).

    Each micro-batch is cached while its groups are written, so a stream that
    may meet a large backlog (a snapshot, a restart after downtime) should
    bound admission with ``max_files_per_trigger``/``max_bytes_per_trigger``
    (files) or ``max_batch_size`` (Kafka offsets).
    """

    name: str = "NoBatchSizeWait"
    max_batch_size: int | None = None
    max_wait_ms: int = 300_000
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None  # bytes; file sources only
    available_now: bool = False

    def by_rows(self, source_format: str) -> bool:
        """Whether batches of files end at ``max_batch_size`` rows."""
        return source_format == "json" and self.name != "NoBatchSizeWait" and bool(self.max_batch_size) and not self.available_now

    def trigger_kwargs(self, by_rows: bool = False) -> dict[str, Any]:
        """Trigger of the query; ``by_rows``: the source itself waits, so it is asked again at once."""
        if self.available_now:
            return {"availableNow": True}
        if self.name == "NoBatchSizeWait" or by_rows:
            return {"processingTime": "0 seconds"}
        return {"processingTime": f"{max(self.max_wait_ms // 10, 1)} milliseconds"}

    def source_options(self, source_format: str) -> dict[str, str]:
        opts: dict[str, str] = {}
        if source_format != "kafka" and self.max_bytes_per_trigger:
            opts["maxBytesPerTrigger"] = str(int(self.max_bytes_per_trigger))
        if self.name == "NoBatchSizeWait":
            if self.max_files_per_trigger and source_format != "kafka":
                opts["maxFilesPerTrigger"] = str(self.max_files_per_trigger)
            return opts
        if source_format == "kafka":
            if self.max_batch_size:
                opts["minOffsetsPerTrigger"] = str(self.max_batch_size)
                opts["maxOffsetsPerTrigger"] = str(self.max_batch_size)
            opts["maxTriggerDelay"] = f"{self.max_wait_ms}ms"
        elif self.max_files_per_trigger:
            opts["maxFilesPerTrigger"] = str(self.max_files_per_trigger)
        return opts


# The wait-strategy names a user may select.
TRIGGER_POLICY_NAMES = ("NoBatchSizeWait", "MaxBatchSizeWait", "DynamicBatchSizeWait")


def select_trigger_policy(name: str, **kwargs: Any) -> TriggerPolicy:
    """Look a policy up by name; unknown names are an error, as in the reference."""
    if name not in TRIGGER_POLICY_NAMES:
        raise ValueError(f"unknown batch-size-wait policy {name!r}; expected one of {TRIGGER_POLICY_NAMES}")
    return TriggerPolicy(name=name, **kwargs)


@dataclass(frozen=True)
class CdcConfig:
    """Options of the lake sink.

    Reference options: ``base_path`` (bucket), ``save_format``, ``save_mode``,
    ``cast_deleted_field``, ``partition`` / ``partition_tz`` (``dt=`` folders),
    ``prefix``, ``dest_regexp`` / ``dest_replace`` (destination -> path) and
    ``trigger`` (batch-size wait).

    Upstream transforms applied here when the events still carry them:
    ``unwrap`` (flatten envelopes), ``snapshot_as_insert``, ``include_tables``,
    ``header_fields``.

    Types: ``logical_types``, ``schema_store``.

    Behaviour: ``on_malformed`` (``fail`` or ``quarantine``), ``legacy_null_ts``,
    ``idempotent`` (exactly-once replays), ``manifest`` (batches visible at once),
    ``lease_seconds`` (drivers that share paths).

    Output: ``write_options``, ``rows_per_file``, ``summary_metadata``,
    ``ingest_log``, ``shared_writes``.

    Scale: ``max_groups``, ``parallel_writes``, ``min_partitions``,
    ``rebalance``, ``small_group_rows`` / ``max_group_tasks``,
    ``batch_storage`` (see the sizing table in the README).
    """

    base_path: str
    save_format: str = "parquet"
    save_mode: str = "append"
    cast_deleted_field: bool = False
    partition: bool = False
    partition_tz: str = "UTC"
    prefix: str = ""
    dest_regexp: str = ""
    dest_replace: str = ""
    unwrap: bool = False
    snapshot_as_insert: bool = False
    include_tables: tuple[str, ...] | None = None
    on_malformed: str = "fail"  # or "quarantine"
    legacy_null_ts: bool = False
    write_options: Mapping[str, str] = field(default_factory=dict)
    rows_per_file: int | None = 1_000_000  # None: a file for each group and partition
    summary_metadata: bool = False
    max_groups: int = 2000
    parallel_writes: int = 8  # destinations written concurrently (each a Spark job)
    ingest_log: bool = True
    min_partitions: int | None = None  # default: the session's default parallelism
    rebalance: str = "auto"  # round-robin the batch: "auto" (narrow inputs), "always" (skewed sources), "never"
    # Small groups (rows <= small_group_rows) are staged once, partitioned by group, when
    # (small groups x batch partitions) would exceed max_group_tasks scan tasks.
    small_group_rows: int = 100_000
    max_group_tasks: int = 20_000
    # Where the keyed batch lives while its groups are written: "cache" (memory and local
    # disk; micro-batches) or "table" (one write to the shared scratch folder, partitioned
    # by group; backfills larger than the cluster's memory, no recompute on executor loss).
    batch_storage: str = "cache"
    trigger: TriggerPolicy = field(default_factory=TriggerPolicy)
    idempotent: bool = False  # replayed batch ids replace their own output instead of appending again
    # Write a file manifest: a batch's rows become visible to readers that go by it all at once, and a
    # batch id that is published already is not landed again (Parquet and ORC; see sources/manifest.py).
    manifest: bool = False
    # Tables as folders ``destination=<name>`` of one root, so that all destinations with one schema are
    # decoded and written by one job, whatever their number.
    shared_writes: bool = False
    logical_types: bool = False  # decimals, dates and timestamps as such, not as what carries them
    # Keep the schema of events without one per table under ``_schemas``; each batch's inferred schema widens it.
    schema_store: bool = False
    # Several drivers write to one path in turn: a write holds the path's lease, which others take
    # over after so many seconds without a sign of life (0: no leases; see sources/leases.py).
    lease_seconds: float = 0
    stream_id: str = ""  # whose batch ids these are, in idempotent mode (default: the streaming query's id)
    add_fields: tuple[str, ...] = DEFAULT_ADD_FIELDS  # envelope and source fields that ``unwrap`` copies
    header_fields: tuple[str, ...] = ()  # as ``add.headers``: ``db`` lands header ``__db`` as column ``__db``

    def with_(self, **kw: Any) -> "CdcConfig":
        return replace(self, **kw)

    @staticmethod
    def from_properties(props: Mapping[str, Any], base_path: str | None = None) -> "CdcConfig":
        """Build a config from flat ``debezium.*`` style properties."""
        sink = config_subset(props, SINK_PREFIX)
        batch = config_subset(props, BATCH_PREFIX)
        source = config_subset(props, SOURCE_PREFIX)
        bp = base_path or sink.get("bucket-name") or "s3a://My-S3-Bucket"
        max_batch = source.get("max.batch.size")
        policy = select_trigger_policy(
            batch.get("batch-size-wait", "NoBatchSizeWait"),
            max_batch_size=int(max_batch) if max_batch else None,
            max_wait_ms=int(batch.get("batch-size-wait.max-wait-ms", "300000")),
        )
        for key in ("format.value", "format.key"):
            fmt = str(props.get(f"debezium.{key}", "json")).lower()
            if fmt != "json":
                raise ValueError(f"debezium.{key}={fmt} not supported; only json")
        return CdcConfig(
            base_path=bp,
            save_format=sink.get("save-format", "parquet"),
            save_mode=sink.get("save-mode", "append"),
            cast_deleted_field=_bool(sink.get("cast-deleted-field", "false")),
            partition=_bool(batch.get("objectkey-partition", "false")),
            partition_tz=batch.get("objectkey-partition-time-zone", "UTC"),
            prefix=batch.get("objectkey-prefix", ""),
            dest_regexp=batch.get("destination-regexp", ""),
            dest_replace=batch.get("destination-regexp-replace", ""),
            trigger=policy,
            header_fields=_names(props.get(HEADERS_KEY)),
            include_tables=_included(props),
            **_unwrapping(props),
        )


def _names(text: Any) -> tuple[str, ...]:
    return tuple(x.strip() for x in str(text or "").split(",") if x.strip())


def _included(props: Mapping[str, Any]) -> tuple[str, ...] | None:
    """Destinations of ``debezium.source.table.include.list`` (``<server name>.<table>``)."""
    tables = _names(props.get(f"{SOURCE_PREFIX}table.include.list"))
    server = props.get(f"{SOURCE_PREFIX}database.server.name") or props.get(f"{SOURCE_PREFIX}topic.prefix")
    return tuple(f"{server}.{t}" if server else t for t in tables) or None


def _unwrapping(props: Mapping[str, Any]) -> dict[str, Any]:
    """The flattening transform: on if ``debezium.transforms`` names one, with its added fields."""
    for name in _names(props.get("debezium.transforms")):
        if str(props.get(f"debezium.transforms.{name}.type", "")).endswith("ExtractNewRecordState"):
            fields = _names(props.get(f"debezium.transforms.{name}.add.fields"))
            return {"unwrap": True, "add_fields": fields}
    return {}


def default_parallelism(spark: SparkSession) -> int:
    """Task slots to spread a batch over (``spark.default.parallelism`` if set)."""
    v = spark.conf.get("spark.default.parallelism", None)
    if v:
        return int(v)
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext (remote session)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: the session's ``spark.checkpoint.dir``.

    When it is unset on a local-mode session (unit tests) a fresh folder is
    created and registered as the checkpoint directory so that later calls and
    ``DataFrame.checkpoint()`` agree on it. On a cluster a machine-local
    folder would not be shared by the executors, so an unset folder is an
    error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; set it to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="cdclake-ckpt-")
        # Core setting, not changeable at runtime; later calls find it through getCheckpointDir().
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared scratch folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/cdclake/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local filesystem checks in tests."""
    return path[5:] if path.startswith("file:") else path


__all__ = [
    "CdcConfig",
    "TriggerPolicy",
    "TRIGGER_POLICY_NAMES",
    "config_subset",
    "default_parallelism",
    "select_trigger_policy",
    "shared_dir",
    "scratch_path",
    "local_path",
]
