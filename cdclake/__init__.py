"""cdclake: land database change events in a data lake with Spark.

Read JSON change events (files, Kafka; batch or streaming), decode each event
with the schema it carries, flatten envelopes, add source-time and delete
markers, split every batch by table and schema version and append typed files
to per-table (optionally ``dt=``-partitioned) paths. Read-back, compaction and
batch/lag reports are plain DataFrame transforms.
"""

from .config import CdcConfig, TriggerPolicy, config_subset, scratch_path, select_trigger_policy, shared_dir
from .functions import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .plans import compact_partition, decode_group, discover_groups, ingest_batch, key_events, write_group
from .sources import encode_events, read_event_stream, read_events, read_table, write_events
from .streaming import ProgressLog, start_stream

__version__ = "0.1.0"
