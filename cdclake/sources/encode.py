"""Encode table rows as CDC change events (JSON ``{schema, payload}`` text).

Everything is one projection of built-in expressions (``to_json``/``concat``),
so encoding is a narrow, shuffle-free map over the input partitions. It serves
as the JSON serialiser of rows and as the way to derive change-event streams
from the given tables for tests and benchmarks.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_days, epoch_micros, long_div
from ..functions.schema import spark_type_to_connect

# Event stream column names and source-metadata constants.
EVENT_COLUMNS = ("destination", "key", "value")
CONNECTOR_VERSION = "1.9.7.Final"
CONNECTORS = ("postgresql", "mysql", "sqlserver", "mongodb")
JSON_OPTS = {"ignoreNullFields": "false"}


def _wire_value(c: Column, dt: T.DataType) -> Column:
    """Column value in its wire form: dates as days, timestamps as micros, decimals as double."""
    if isinstance(dt, T.DateType):
        return epoch_days(c)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(c)
    if isinstance(dt, T.DecimalType):
        return c.cast("double")
    return c


def _row_struct(df: DataFrame, cols: Sequence[str]) -> tuple[Column, list[dict]]:
    fields = {f.name: f for f in df.schema.fields}
    values, nodes = [], []
    for name in cols:
        f = fields[name]
        values.append(_wire_value(F.col(name), f.dataType).alias(name))
        node = spark_type_to_connect(f.dataType, name)
        node["optional"] = True
        nodes.append(node)
    return F.struct(*values), nodes


def _value_text(schema: dict | None | str, payload: Column) -> Column:
    body = F.to_json(payload, JSON_OPTS)
    if schema is None:
        return body
    if schema == "null":
        return F.concat(F.lit('{"schema":null,"payload":'), body, F.lit("}"))
    text = json.dumps(schema, separators=(",", ":"))
    return F.concat(F.lit('{"schema":' + text + ',"payload":'), body, F.lit("}"))


def _source_struct(connector: str, server: str, db: str, table: str | Column, ts_ms: Column,
                   position: Column, snapshot: Column) -> tuple[Column, dict]:
    """Source block in the shape of a Postgres or a MySQL connector."""
    common = [
        (F.lit(CONNECTOR_VERSION), "version", {"type": "string"}),
        (F.lit(connector), "connector", {"type": "string"}),
        (F.lit(server), "name", {"type": "string"}),
        (ts_ms.cast("bigint"), "ts_ms", {"type": "int64"}),
    ]
    tbl = table if isinstance(table, Column) else F.lit(table)
    if connector == "postgresql":
        rest = [
            (F.when(snapshot, F.lit("true")).otherwise(F.lit("false")), "snapshot", {"type": "string", "name": "io.debezium.data.Enum", "parameters": {"allowed": "true,last,false"}}),
            (F.lit(db), "db", {"type": "string"}),
            (F.lit("public"), "schema", {"type": "string"}),
            (tbl, "table", {"type": "string"}),
            (long_div(position.cast("bigint"), 16), "txId", {"type": "int64"}),
            (position.cast("bigint"), "lsn", {"type": "int64"}),
            (F.lit(None).cast("bigint"), "xmin", {"type": "int64"}),
        ]
    elif connector == "mysql":
        rest = [
            (snapshot, "snapshot", {"type": "boolean"}),
            (F.lit(db), "db", {"type": "string"}),
            (tbl, "table", {"type": "string"}),
            (F.lit(223344).cast("bigint"), "server_id", {"type": "int64"}),
            (F.lit(None).cast("string"), "gtid", {"type": "string"}),
            (F.lit("mysql-bin.000003"), "file", {"type": "string"}),
            (position.cast("bigint"), "pos", {"type": "int64"}),
            (F.lit(0), "row", {"type": "int32"}),
            (F.lit(7).cast("bigint"), "thread", {"type": "int64"}),
            (F.lit(None).cast("string"), "query", {"type": "string"}),
        ]
    elif connector == "sqlserver":
        lsn_text = position.cast("bigint").cast("string")
        rest = [
            (F.when(snapshot, F.lit("true")).otherwise(F.lit("false")), "snapshot", {"type": "string", "name": "io.debezium.data.Enum", "parameters": {"allowed": "true,last,false"}}),
            (F.lit(db), "db", {"type": "string"}),
            (F.lit(None).cast("string"), "sequence", {"type": "string"}),
            (F.lit("dbo"), "schema", {"type": "string"}),
            (tbl, "table", {"type": "string"}),
            (lsn_text, "change_lsn", {"type": "string"}),
            (lsn_text, "commit_lsn", {"type": "string"}),
            (F.lit(1).cast("bigint"), "event_serial_no", {"type": "int64"}),
        ]
    elif connector == "mongodb":
        rest = [
            (F.when(snapshot, F.lit("true")).otherwise(F.lit("false")), "snapshot", {"type": "string", "name": "io.debezium.data.Enum", "parameters": {"allowed": "true,last,false"}}),
            (F.lit(db), "db", {"type": "string"}),
            (F.lit(None).cast("string"), "sequence", {"type": "string"}),
            (F.lit("rs0"), "rs", {"type": "string"}),
            (tbl, "collection", {"type": "string"}),
            (F.lit(1), "ord", {"type": "int32"}),
            (F.lit(None).cast("string"), "lsid", {"type": "string"}),
            (F.lit(None).cast("bigint"), "txnNumber", {"type": "int64"}),
        ]
    else:
        raise ValueError(f"unsupported connector {connector!r}")
    cols, nodes = [], []
    for col, name, node in common + rest:
        cols.append(col.alias(name))
        nodes.append({**node, "field": name,
                      "optional": name not in ("version", "connector", "name", "ts_ms", "db", "table", "rs", "collection", "ord")})
    return F.struct(*cols), {"type": "struct", "name": "io.debezium.connector.%s.Source" % connector, "optional": False, "field": "source", "fields": nodes}


def encode_events(
    df: DataFrame,
    destination: str | Column,
    *,
    key: Sequence[str] | None = None,
    style: str = "flat",
    op: Column | None = None,
    source_ts_ms: Column | None = None,
    lsn: Column | None = None,
    versions: Sequence[tuple[Column | None, Sequence[str]]] | None = None,
    before_overrides: dict[str, Column] | None = None,
    with_schema: bool | str = True,
    connector: str | Column = "postgresql",
    server: str = "testc",
    db: str = "inventory",
    table: str | None = None,
    tombstones: bool = False,
    malformed: Column | None = None,
    headers: dict[str, Column] | None = None,
) -> DataFrame:
    """Encode each row of ``df`` as one change event ``(destination, key, value)``.

    ``style='flat'``: the payload is the row plus ``__op, __table, __lsn,
    __source_ts_ms, __deleted`` (the shape a flattening transform emits).
    ``style='envelope'``: ``{before, after, source, op, ts_ms}``; deletes carry
    only ``before``, updates carry ``before`` with ``before_overrides`` applied.
    ``versions``: list of ``(condition, columns[, with_source_ts])``; the first
    matching condition (``None`` = always) picks the row's column set and thus
    its schema version (``with_source_ts=False`` leaves ``__source_ts_ms`` out,
    like heartbeat events). ``headers`` adds a ``headers`` map column (record
    headers, e.g. ``{"__db": ...}``). ``connector`` (``postgresql``, ``mysql``,
    ``sqlserver``, ``mongodb``) shapes the ``source`` block; the row images stay
    structs for all of them (a real MongoDB connector sends ``after`` as JSON
    text); it may also be a column of these names, to mix dialects in one
    stream. ``tombstones`` adds a null-value event
    after every delete; ``malformed`` truncates the JSON text where true.
    """
    op = op if op is not None else F.lit("c")
    dest = destination if isinstance(destination, Column) else F.lit(destination)
    tbl_name = table or (destination.rsplit(".", 1)[-1] if isinstance(destination, str) else None)
    tbl = F.lit(tbl_name) if tbl_name else F.substring_index(dest, ".", -1)
    if versions is None:
        versions = [(None, [c for c in df.columns])]
    ts_col = source_ts_ms.cast("bigint") if source_ts_ms is not None else None
    lsn_col = lsn.cast("bigint") if lsn is not None else F.lit(None).cast("bigint")

    def one_version(cols: Sequence[str], conn: str, with_ts: bool = True) -> Column:
        row, nodes = _row_struct(df, cols)
        if style == "flat":
            meta = [(op, "__op", "string"), (tbl, "__table", "string"), (lsn_col, "__lsn", "int64")]
            if ts_col is not None and with_ts:
                meta.append((ts_col, "__source_ts_ms", "int64"))
            meta.append((F.when(op == "d", F.lit("true")).otherwise(F.lit("false")), "__deleted", "string"))
            payload = F.struct(*[row.getField(c).alias(c) for c in cols], *[c.alias(n) for c, n, _ in meta])
            schema = {"type": "struct", "optional": False, "name": f"{server}.{db}.{tbl_name or 'table'}.Value",
                      "fields": nodes + [{"type": t, "optional": True, "field": n} for _, n, t in meta]}
        elif style == "envelope":
            if before_overrides:
                fields = {f.name: f for f in df.schema.fields}
                prev = F.struct(*[(_wire_value(before_overrides[c], fields[c].dataType) if c in before_overrides
                                   else row.getField(c)).alias(c) for c in cols])
            else:
                prev = row
            null_row = F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType)
            before = F.when(op == "d", row).when(op == "u", prev).otherwise(null_row)
            after = F.when(op == "d", null_row).otherwise(row)
            ts = ts_col if ts_col is not None else F.lit(0).cast("bigint")
            source, source_node = _source_struct(conn, server, db, tbl, ts, lsn_col, op == "r")
            payload = F.struct(before.alias("before"), after.alias("after"), source.alias("source"),
                               op.alias("op"), (ts + 1000).alias("ts_ms"))
            value_node = {"type": "struct", "fields": nodes, "optional": True, "name": f"{server}.{db}.{tbl_name or 'table'}.Value"}
            schema = {"type": "struct", "optional": False, "name": f"{server}.{db}.{tbl_name or 'table'}.Envelope",
                      "fields": [value_node | {"field": "before"}, value_node | {"field": "after"}, source_node,
                                 {"type": "string", "optional": False, "field": "op"},
                                 {"type": "int64", "optional": True, "field": "ts_ms"}]}
        else:
            raise ValueError(f"unknown style {style!r}")
        return _value_text(schema if with_schema is True else ("null" if with_schema == "null" else None), payload)

    def by_connector(cols: Sequence[str], with_ts: bool) -> Column:
        if isinstance(connector, Column):
            out = one_version(cols, "postgresql", with_ts)
            for other in CONNECTORS[1:]:
                out = F.when(connector == other, one_version(cols, other, with_ts)).otherwise(out)
            return out
        return one_version(cols, connector, with_ts)

    value = None
    for version in reversed(list(versions)):
        cond, cols = version[0], version[1]
        v = by_connector(cols, version[2] if len(version) > 2 else True)
        value = v if (cond is None or value is None) else F.when(cond, v).otherwise(value)
    if malformed is not None:
        # Cut the JSON text in half: an unparsable event, as a broken producer would send.
        value = F.when(malformed, F.left(value, (F.length(value) / 2).cast("int"))).otherwise(value)

    key_col = F.lit(None).cast("string")
    if key:
        krow, knodes = _row_struct(df, key)
        kschema = {"type": "struct", "optional": False, "name": f"{server}.{db}.{tbl_name or 'table'}.Key", "fields": knodes}
        key_col = _value_text(kschema if with_schema else None, krow)

    cols = list(EVENT_COLUMNS)
    hdr = []
    if headers:
        pairs = [x for k, v in headers.items() for x in (F.lit(k), v.cast("string"))]
        hdr = [F.create_map(*pairs).alias("headers")]
        cols.append("headers")
    # Spark copies a filter on encoded text below the projection and encodes there again for every use of the text;
    # it leaves filters above a projection with a partition's number.
    out = df.select(dest.alias("destination"), key_col.alias("key"), value.alias("value"), *hdr,
                    op.alias("__op_tmp"), F.spark_partition_id().alias("__part")).where(F.col("__part") >= 0)
    if tombstones:
        out = out.select("destination", "key", *cols[3:], F.explode(
            F.when(F.col("__op_tmp") == "d", F.array(F.col("value"), F.lit(None).cast("string")))
            .otherwise(F.array(F.col("value")))).alias("value"))
    return out.select(*cols)
