"""Schema helpers: embedded (Connect-style) JSON schema <-> Spark types.

These run on the driver, once per *distinct* schema text of a micro-batch; the
resulting ``StructType`` then drives a distributed ``from_json``.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import types as T

# Connect primitive type name -> Spark type. The logical type
# (``name``), ``version``, ``optional`` and ``default`` do not change the
# physical type; every field is nullable. Unknown names become strings.
CONNECT_PRIMITIVES: dict[str, T.DataType] = {
    "int8": T.IntegerType(),
    "int16": T.IntegerType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float8": T.FloatType(),
    "float16": T.FloatType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}

# Metadata columns added to every decoded row.
SOURCE_TS = "__source_ts"
SOURCE_TS_MS = "__source_ts_ms"
DELETED = "__deleted"


def _as_node(schema: Any) -> Any:
    if isinstance(schema, (str, bytes)):
        return json.loads(schema)
    return schema


def connect_type_to_spark(node: dict) -> T.DataType:
    """Spark type of one Connect schema node (a field or an ``items``/``values`` node)."""
    kind = node.get("type")
    if kind == "struct":
        return connect_schema_to_struct(node)
    if kind == "array":
        items = node.get("items")
        return T.ArrayType(connect_type_to_spark(items) if isinstance(items, dict) else T.StringType(), True)
    if kind == "map":
        values = node.get("values")
        return T.MapType(T.StringType(), connect_type_to_spark(values) if isinstance(values, dict) else T.StringType(), True)
    return CONNECT_PRIMITIVES.get(kind, T.StringType())


def connect_schema_to_struct(schema: Any) -> T.StructType | None:
    """Compile a Connect struct schema (dict or JSON text) to a ``StructType``.

    ``None`` (no embedded schema) gives ``None``; callers then infer.
    """
    node = _as_node(schema)
    if node is None:
        return None
    fields = []
    for f in node.get("fields") or []:
        fields.append(T.StructField(f["field"], connect_type_to_spark(f), True))
    return T.StructType(fields)


def augment_schema(struct: T.StructType) -> T.StructType:
    """Add ``__source_ts`` (timestamp) and, unless declared, ``__source_ts_ms`` (bigint).

    A declared ``__source_ts`` is replaced rather than duplicated.
    """
    kept = [f for f in struct.fields if f.name != SOURCE_TS]
    out = T.StructType(kept).add(SOURCE_TS, T.TimestampType(), True)
    if SOURCE_TS_MS not in struct.fieldNames():
        out = out.add(SOURCE_TS_MS, T.LongType(), True)
    return out


def canonical_schema(schema: Any) -> str | None:
    """Canonical text of a schema: the Spark type it compiles to.

    Two embedded schemas with the same canonical text decode to identical
    rows, so their events can share one write.
    """
    struct = connect_schema_to_struct(schema)
    return None if struct is None else struct.json()


def spark_type_to_connect(dt: T.DataType, name: str | None = None) -> dict:
    """Connect schema node for a Spark type (used when encoding rows as events).

    Dates become ``int32`` days and timestamps ``int64`` microseconds, with the
    usual logical names; decimals are carried as ``float64``.
    """
    node: dict[str, Any]
    if isinstance(dt, T.StructType):
        node = {"type": "struct", "fields": [spark_type_to_connect(f.dataType, f.name) | {"optional": True} for f in dt.fields]}
    elif isinstance(dt, T.ArrayType):
        node = {"type": "array", "items": spark_type_to_connect(dt.elementType)}
    elif isinstance(dt, T.MapType):
        node = {"type": "map", "keys": spark_type_to_connect(dt.keyType), "values": spark_type_to_connect(dt.valueType)}
    elif isinstance(dt, T.ByteType):
        node = {"type": "int8"}
    elif isinstance(dt, T.ShortType):
        node = {"type": "int16"}
    elif isinstance(dt, T.IntegerType):
        node = {"type": "int32"}
    elif isinstance(dt, T.LongType):
        node = {"type": "int64"}
    elif isinstance(dt, T.FloatType):
        node = {"type": "float32"}
    elif isinstance(dt, (T.DoubleType, T.DecimalType)):
        node = {"type": "float64"}
    elif isinstance(dt, T.BooleanType):
        node = {"type": "boolean"}
    elif isinstance(dt, T.BinaryType):
        node = {"type": "bytes"}
    elif isinstance(dt, T.DateType):
        node = {"type": "int32", "name": "io.debezium.time.Date", "version": 1}
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        node = {"type": "int64", "name": "io.debezium.time.MicroTimestamp", "version": 1}
    else:
        node = {"type": "string"}
    if name is not None:
        node["field"] = name
    return node


def struct_to_connect(struct: T.StructType, name: str | None = None, optional: bool = False) -> dict:
    node = spark_type_to_connect(struct, name)
    node["optional"] = optional
    return node


def inferred_type_to_spark(dt: T.DataType) -> T.DataType:
    """Map a type inferred from JSON values (via variant) to JSON-reader types.

    Whole numbers become ``bigint`` (``decimal(38,0)`` beyond 18 digits),
    fractional numbers ``double``, null-only fields ``string``.
    """
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, inferred_type_to_spark(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(inferred_type_to_spark(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(T.StringType(), inferred_type_to_spark(dt.valueType), True)
    if isinstance(dt, T.DecimalType):
        if dt.scale == 0:
            return T.LongType() if dt.precision <= 18 else T.DecimalType(38, 0)
        return T.DoubleType()
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return T.LongType()
    if isinstance(dt, (T.FloatType,)):
        return T.DoubleType()
    if isinstance(dt, (T.NullType, T.VariantType)):
        return T.StringType()
    return dt
