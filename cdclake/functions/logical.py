"""Logical types of embedded schemas: exact decimals, dates and timestamps from what events carry.

Events carry a decimal as the bytes of its unscaled two's complement number,
a date as days and a timestamp as milliseconds, microseconds or nanoseconds. Built-in functions only.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of logical types, by what they hold.
DECIMAL = "org.apache.kafka.connect.data.Decimal"
DAYS = ("io.debezium.time.Date", "org.apache.kafka.connect.data.Date")
MILLIS = ("io.debezium.time.Timestamp", "org.apache.kafka.connect.data.Timestamp")
MICROS = "io.debezium.time.MicroTimestamp"
NANOS = "io.debezium.time.NanoTimestamp"
ZONED = "io.debezium.time.ZonedTimestamp"
PRECISION = "connect.decimal.precision"


def decimal_of(octets: Column, precision: int, scale: int) -> Column:
    """The decimal whose unscaled number is a big-endian two's complement of up to 16 bytes, exactly; null if it has more digits."""
    digits = F.hex(octets)
    negative = F.substring(digits, 1, 1) >= "8"
    # Of a negative number the bits are turned, which gives one less than its amount.
    padded = F.lpad(F.when(negative, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(digits), 32, "0")
    half = lambda at: F.conv(F.substring(padded, at, 16), 16, 10).cast("decimal(20,0)")
    amount = F.try_add(F.try_multiply(half(1), F.lit("18446744073709551616").cast("decimal(20,0)")), half(17))
    amount = amount.cast("decimal(38,0)")
    most = F.lit("9" * 38).cast("decimal(38,0)")
    # Subtraction and text, since the sign and the absolute value of a decimal round it to 34 digits.
    whole = F.when(~negative, amount).when(amount < most, (F.lit(-1).cast("decimal(38,0)") - amount).cast("decimal(38,0)"))
    shown = F.replace(whole.cast("string"), F.lit("-"), F.lit(""))
    text = F.lpad(shown, F.greatest(F.length(shown), F.lit(scale + 1)), F.lit("0"))
    sign = F.when(whole < 0, F.lit("-")).otherwise(F.lit(""))
    left, right = F.substring(text, F.lit(1), F.length(text) - scale), F.substring(text, F.length(text) - scale + 1, F.lit(max(scale, 1)))
    point = F.concat(sign, left, F.lit("."), right) if scale > 0 else F.concat(sign, text)
    return F.when((F.length(digits) > 0) & (F.length(digits) <= 32), point.try_cast(f"decimal({precision},{scale})"))


def _decimal_type(node: dict) -> tuple[int, int]:
    parameters = node.get("parameters") or {}
    scale = int(parameters.get("scale", 0))
    return max(min(int(parameters.get(PRECISION, 38)), 38), scale, 1), scale


def is_logical(node: Any) -> bool:
    """Whether a schema node, or one within it, has a logical type that is converted."""
    if not isinstance(node, dict):
        return False
    if node.get("name") in (DECIMAL, *DAYS, *MILLIS, MICROS, NANOS, ZONED):
        return True
    return any(is_logical(x) for x in (node.get("items"), node.get("values"), *(node.get("fields") or [])))


def logical_column(c: Column, node: dict) -> Column:
    """The value of a decoded field as its logical type; other fields stay as they are."""
    name = node.get("name")
    if name == DECIMAL and node.get("type") == "bytes":
        precision, scale = _decimal_type(node)
        return decimal_of(c, precision, scale) if 0 <= scale <= 38 else c
    if name in DAYS:
        return F.date_from_unix_date(c)
    if name in MILLIS:
        return F.timestamp_millis(c)
    if name == MICROS:
        return F.timestamp_micros(c)
    if name == NANOS:
        return F.timestamp_micros(F.floor(c.cast("decimal(20,0)") / 1000).cast("bigint"))
    if name == ZONED:
        return F.try_to_timestamp(c)
    if not is_logical(node):
        return c
    if node.get("type") == "struct":
        return F.when(c.isNotNull(), F.struct(*[logical_column(c.getField(f["field"]), f).alias(f["field"]) for f in node["fields"]]))
    if node.get("type") == "array":
        return F.transform(c, lambda x: logical_column(x, node["items"]))
    if node.get("type") == "map":
        return F.transform_values(c, lambda _, x: logical_column(x, node["values"]))
    return c


def with_logical_types(df: DataFrame, schema: Any) -> DataFrame:
    """Decoded rows with the columns of ``schema`` (a Connect struct schema) as their logical types."""
    node = json.loads(schema) if isinstance(schema, str) else schema
    known = {f["field"]: f for f in node.get("fields") or [] if is_logical(f)}
    quoted = lambda x: F.col("`" + x.replace("`", "``") + "`")
    return df.select(*[logical_column(quoted(x), known[x]).alias(x) if x in known else quoted(x) for x in df.columns])


def logical_signature(schema: Any) -> str:
    """What tells two schemas of one physical type apart: their logical types, by place."""
    node = json.loads(schema) if isinstance(schema, str) else schema

    def of(x: Any) -> Any:
        if not is_logical(x):
            return None
        inner = [of(y) for y in (x.get("items"), x.get("values"), *(x.get("fields") or []))]
        return [x.get("name") if is_logical({"name": x.get("name")}) else None, _decimal_type(x) if x.get("name") == DECIMAL else None, inner]

    return json.dumps(of(node))


__all__ = ["decimal_of", "is_logical", "logical_column", "logical_signature", "with_logical_types"]
