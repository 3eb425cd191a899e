"""Row transforms on decoded change rows: flatten, enrich, cast, normalise."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ADD_FIELDS
from ..functions.columns import deleted_as_bool, long_div, source_ts
from ..functions.schema import DELETED, SOURCE_TS, SOURCE_TS_MS

# Fields of the envelope itself.
ENVELOPE_TOP_FIELDS = ("op", "ts_ms")
# Types of source fields that are not strings, the same for every connector, so that
# tables which events of several connectors reach keep one schema.
SOURCE_FIELD_TYPES = {"ts_ms": "bigint", "txId": "bigint", "lsn": "bigint", "xmin": "bigint", "server_id": "bigint", "pos": "bigint",
                      "row": "int", "thread": "bigint", "event_serial_no": "bigint", "ord": "int", "txnNumber": "bigint"}


def _field_type(df: DataFrame, path: Sequence[str]) -> T.DataType | None:
    dt: T.DataType = df.schema
    for p in path:
        if not isinstance(dt, T.StructType) or p not in dt.fieldNames():
            return None
        dt = dt[p].dataType
    return dt


def added_field_name(spec: str) -> str:
    """Output name of an added field: dots become underscores, prefixed by ``__``."""
    return "__" + spec.replace(".", "_")


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unwrap(df: DataFrame, add_fields: Sequence[str] = DEFAULT_ADD_FIELDS, *, rewrite_deletes: bool = True,
           keep: Sequence[str] = ()) -> DataFrame:
    """Flatten a ``{before, after, source, op, ts_ms}`` envelope into the row image.

    Non-deletes take ``after``; deletes keep ``before`` and, with
    ``rewrite_deletes``, are marked ``__deleted='true'`` (others ``'false'``).
    ``add_fields`` copies envelope/source fields: ``op`` and ``ts_ms`` from the
    envelope, ``source.x`` or a bare source field name from ``source``. Fields
    the source does not have (another connector) are null; their types do not
    depend on the connector (``SOURCE_FIELD_TYPES``, else string).
    """
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.coalesce(F.col("after"), F.col("before")))
    row_type = _field_type(df, ["after"]) or _field_type(df, ["before"])
    cols: list[Column] = [F.col(k) for k in keep]
    if isinstance(row_type, T.StructType):
        cols += [image.getField(f.name).alias(f.name) for f in row_type.fields]
    for spec in add_fields:
        path = spec.split(".") if "." in spec else ([spec] if spec in ENVELOPE_TOP_FIELDS else ["source", spec])
        name = added_field_name(spec)
        typ = SOURCE_FIELD_TYPES.get(path[-1], "string")
        if _field_type(df, path) is None:
            cols.append(F.lit(None).cast(typ).alias(name))
        else:
            c = quoted(path[0])
            for p in path[1:]:
                c = c.getField(p)
            cols.append((c if isinstance(_field_type(df, path), (T.StructType, T.ArrayType, T.MapType)) else c.cast(typ)).alias(name))
    if rewrite_deletes:
        cols.append(F.when(F.col("op") == "d", F.lit("true")).otherwise(F.lit("false")).alias(DELETED))
    return df.select(*cols)


def snapshot_as_insert(df: DataFrame, op: str = "__op") -> DataFrame:
    """Report snapshot reads (``r``) as inserts (``c``)."""
    return df.withColumn(op, F.when(F.col(op) == "r", F.lit("c")).otherwise(F.col(op)))


def add_source_ts(df: DataFrame, batch_time_ms: int, *, legacy_null_ts: bool = False,
                  present: Column | None = None) -> DataFrame:
    """Add ``__source_ts`` (and ``__source_ts_ms`` when the rows have none).

    With a ``__source_ts_ms`` column: ``__source_ts`` = its whole seconds.
    Without one: both are the batch time (one value for the whole batch).
    ``present`` (optional boolean column) marks rows whose payload actually
    had the field; the others take the batch time too.
    """
    batch_ms = F.lit(int(batch_time_ms)).cast("bigint")
    cols = [c for c in df.columns if c != SOURCE_TS]
    if SOURCE_TS_MS in cols:
        ms = F.col(SOURCE_TS_MS).cast("bigint")
        if present is not None:
            ms = F.when(present, ms).otherwise(batch_ms)
        return df.select(*[ms.alias(c) if c == SOURCE_TS_MS else quoted(c) for c in cols],
                         source_ts(ms, legacy_null_ts).alias(SOURCE_TS))
    return df.select(*[quoted(c) for c in cols], F.timestamp_seconds(long_div(batch_ms, 1000)).alias(SOURCE_TS),
                     batch_ms.alias(SOURCE_TS_MS))


def cast_deleted(df: DataFrame, column: str = DELETED) -> DataFrame:
    """Cast the ``'true'/'false'`` delete marker to boolean; no-op if absent."""
    if column not in df.columns:
        return df
    return df.withColumn(column, deleted_as_bool(F.col(column)))


# The common source-position struct of the bundled connectors
# (Postgres, MySQL, SQL Server, MongoDB): output field, type, and the source
# fields that carry it (the first one present wins).
SOURCE_POSITION_FIELDS = (
    ("connector", "string", ("connector",)),
    ("db", "string", ("db",)),
    ("schema", "string", ("schema",)),
    ("table", "string", ("table", "collection")),
    ("ts_ms", "bigint", ("ts_ms",)),
    ("snapshot", "string", ("snapshot",)),
    ("tx_id", "bigint", ("txId", "txnNumber")),
    ("lsn", "bigint", ("lsn",)),
    ("binlog_file", "string", ("file",)),
    ("binlog_pos", "bigint", ("pos",)),
    ("binlog_row", "int", ("row",)),
    ("gtid", "string", ("gtid",)),
    ("server_id", "bigint", ("server_id",)),
    ("change_lsn", "string", ("change_lsn",)),
    ("commit_lsn", "string", ("commit_lsn",)),
    ("event_serial_no", "bigint", ("event_serial_no",)),
    ("replica_set", "string", ("rs",)),
    ("oplog_ord", "int", ("ord",)),
)


def normalize_source(df: DataFrame, source: str = "source", out: str = "source_position") -> DataFrame:
    """Replace the dialect-specific ``source`` struct by one common position struct.

    Postgres (``txId, lsn, schema``), MySQL (``file, pos, row, gtid,
    server_id``), SQL Server (``change_lsn, commit_lsn, event_serial_no``) and
    MongoDB (``rs, collection, ord, txnNumber``) sources map onto the same
    fields; absent ones are null, so frames from all connectors union by name.
    """
    parts = []
    for name, typ, srcs in SOURCE_POSITION_FIELDS:
        present = [F.col(source).getField(f).cast(typ) for f in srcs if _field_type(df, [source, f]) is not None]
        value = F.coalesce(*present) if len(present) > 1 else (present[0] if present else F.lit(None).cast(typ))
        parts.append(value.alias(name))
    return df.withColumn(out, F.struct(*parts)).drop(source)


HEADERS = "headers"


def header_value(headers: Column, dt: T.DataType, key: str) -> Column:
    """Text of header ``key``: a map lookup, or for the Kafka shape
    (``array<struct<key, value>>``) the last header with that key."""
    if isinstance(dt, T.MapType):
        return headers.getItem(key).cast("string")
    match = F.filter(headers, lambda h: h.getField("key") == F.lit(key))
    return F.try_element_at(match, F.lit(-1)).getField("value").cast("string")


def add_headers(df: DataFrame, fields: Sequence[str], *, headers: str = HEADERS) -> DataFrame:
    """Copy header fields into columns and drop the header column.

    ``fields`` are given like the flattening transform's ``add.headers``
    (``db`` is carried as header ``__db`` and lands as column ``__db``). A
    payload field of the same name wins; without a header column the fields
    are null, so the landed schema does not depend on the source.
    """
    dt = df.schema[headers].dataType if headers in df.columns else None
    for spec in fields:
        name = added_field_name(spec)
        if name in df.columns:
            continue
        value = header_value(F.col(headers), dt, name) if dt is not None else F.lit(None).cast("string")
        df = df.withColumn(name, value)
    return df.drop(headers) if dt is not None else df
