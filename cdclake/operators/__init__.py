from .decode import decode_key, decode_payload, infer_payload_schema
from .envelope import (drop_tombstones, event_kind, include_tables, malformed_flag, schema_text, split_envelope,
                       split_malformed)
from .mongo import decode_documents, latest_documents, plain_json
from .reports import batch_sizes, batch_utilisation, lag_report, progress_by_interval, progress_report, snapshot_state
from .transform import add_headers, add_source_ts, cast_deleted, normalize_source, snapshot_as_insert, unwrap

__all__ = [
    "add_headers", "add_source_ts", "batch_sizes", "batch_utilisation", "cast_deleted", "decode_documents", "decode_key", "decode_payload",
    "drop_tombstones", "event_kind", "include_tables", "infer_payload_schema", "lag_report", "latest_documents", "malformed_flag",
    "normalize_source", "plain_json", "progress_by_interval", "progress_report", "schema_text", "snapshot_as_insert", "snapshot_state",
    "split_envelope", "split_malformed", "unwrap",
]
