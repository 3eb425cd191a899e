from .progress import ProgressLog
from .stream import start_stream

__all__ = ["ProgressLog", "start_stream"]
