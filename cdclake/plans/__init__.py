from .compact import commit_compaction, compact_partition
from .ingest import (BatchResult, GroupResult, SchemaGroup, decode_events, decode_group, discover_groups, group_path, ingest_batch,
                     key_events, write_group)

__all__ = ["BatchResult", "GroupResult", "SchemaGroup", "commit_compaction", "compact_partition", "decode_events", "decode_group", "discover_groups",
           "group_path", "ingest_batch", "key_events", "write_group"]
