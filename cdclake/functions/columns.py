"""Column functions (all built-in Spark expressions, codegen friendly)."""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Epoch literal and the file-name pattern carrying the write id.
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
WRITE_ID_PATTERN = r"-\d+-([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def long_div(c: Column, n: int) -> Column:
    """Integral division truncating toward zero (Java ``long`` semantics)."""
    return ((c - c % n) / n).cast("bigint")


def source_ts(ms: Column | str, legacy_null_ts: bool = False) -> Column:
    """``__source_ts``: whole seconds of ``__source_ts_ms`` (truncated toward zero).

    A null millisecond value gives null, or 1970-01-01 with ``legacy_null_ts``.
    """
    m = _c(ms).cast("bigint")
    if legacy_null_ts:
        m = F.coalesce(m, F.lit(0).cast("bigint"))
    return F.timestamp_seconds(long_div(m, 1000))


def deleted_as_bool(c: Column | str = "__deleted") -> Column:
    """``'true'/'false'`` delete marker to boolean; anything else gives null."""
    return _c(c).try_cast(T.BooleanType())


def map_destination(dest: Column | str, regexp: str = "", replace: str = "") -> Column:
    """Rewrite a destination with a Java regex (``$1`` style groups)."""
    d = _c(dest)
    if not regexp:
        return d
    return F.regexp_replace(d, F.lit(regexp), F.lit(replace or ""))


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since epoch of a ``timestamp_ntz`` (UTC wall clock) column."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts).cast("timestamp_ntz"))


def epoch_days(ts: Column | str) -> Column:
    """Days since epoch of a date / timestamp_ntz column."""
    return F.unix_date(_c(ts).cast("timestamp_ntz").cast("date"))


def utc_wall_clock(ms: Column | str) -> Column:
    """``timestamp_ntz`` holding the UTC wall clock of epoch milliseconds.

    Independent of the session time zone.
    """
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_millis(_c(ms).cast("bigint")).cast("timestamp_ntz"))


def partition_date(ms: Column | str, tz: str = "UTC") -> Column:
    """``dt=YYYY-MM-DD`` of epoch milliseconds in zone ``tz``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall_clock(ms))
    return F.concat(F.lit("dt="), F.date_format(local, "yyyy-MM-dd"))


def partition_date_text(batch_time_ms: int, tz: str = "UTC") -> str:
    """Driver-side twin of :func:`partition_date` for one batch time."""
    t = _dt.datetime.fromtimestamp(batch_time_ms / 1000.0, tz=ZoneInfo(tz))
    return f"dt={t.year:04d}-{t.month:02d}-{t.day:02d}"


def target_path(dest: Column | str, base_path: str, prefix: str = "", regexp: str = "", replace: str = "",
                dt: Column | str | None = None) -> Column:
    """``base/prefix + mapped(dest)[/dt=...]``; a null destination raises."""
    d = _c(dest)
    checked = F.when(d.isNull(), F.raise_error(F.lit("destination cannot be null"))).otherwise(d)
    parts = [F.lit(base_path.rstrip("/") + "/"), F.lit(prefix), map_destination(checked, regexp, replace)]
    if dt is not None:
        parts += [F.lit("/"), _c(dt)]
    return F.concat(*parts)


def target_path_text(dest: str, base_path: str, prefix: str = "", regexp: str = "", replace: str = "",
                     dt: str | None = None) -> str:
    """Driver-side path for one destination (same rule as :func:`target_path`).

    The mapping is Java's regex in the driver's JVM, as in :func:`map_destination`.
    """
    if dest is None:
        raise ValueError("destination cannot be null")
    mapped = dest
    if regexp:
        jvm = SparkContext._active_spark_context._jvm  # also in threads that have no session
        mapped = jvm.java.util.regex.Pattern.compile(regexp).matcher(dest).replaceAll(replace or "")
    path = base_path.rstrip("/") + "/" + prefix + mapped
    return path + "/" + dt if dt else path


def write_id(file_name: Column | str) -> Column:
    """The per-write UUID embedded in Spark output file names."""
    return F.regexp_extract(_c(file_name), WRITE_ID_PATTERN, 1)
