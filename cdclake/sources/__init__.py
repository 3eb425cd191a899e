from .encode import EVENT_COLUMNS, encode_events
from .events import EVENT_SCHEMA, read_event_stream, read_events, write_events
from .tables import COMMIT_FILES, INPUT_FILE, commit_files, read_table

__all__ = ["COMMIT_FILES", "commit_files", "EVENT_COLUMNS", "EVENT_SCHEMA", "INPUT_FILE", "encode_events", "read_event_stream", "read_events",
           "read_table", "write_events"]
