"""Inline change events for tests (our own, in the usual converter shapes)."""

import json


def fld(fname, typ, **kw):
    return {"type": typ, "field": fname, "optional": True} | kw


def value(fields, payload, *, schema=True, name="Value"):
    if not schema:
        return json.dumps(payload, separators=(",", ":"))
    sch = {"type": "struct", "optional": False, "name": name, "fields": fields}
    return json.dumps({"schema": sch, "payload": payload}, separators=(",", ":"))


META = [fld("__op", "string"), fld("__table", "string"), fld("__lsn", "int64"), fld("__source_ts_ms", "int64"),
        fld("__deleted", "string")]


def flat(fields, row, op="c", table="t", lsn=1, ts_ms=1_600_000_000_123, **kw):
    payload = dict(row) | {"__op": op, "__table": table, "__lsn": lsn, "__source_ts_ms": ts_ms,
                           "__deleted": "true" if op == "d" else "false"}
    return value(fields + META, payload, **kw)


def events(spark, rows):
    """rows: (destination, key, value) tuples."""
    return spark.createDataFrame(rows, "destination string, key string, value string")
