"""Event-level operators: envelope split, tombstones, table filter, malformed split.

All are narrow projections/filters on built-in JSON functions: they work on
static and streaming frames and never shuffle.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event kinds derived from the value text.
KIND_MALFORMED = 0
KIND_DECLARED = 1  # {"schema": {...}, "payload": ...}
KIND_ENVELOPED_NO_SCHEMA = 2  # {"schema": null, "payload": ...}
KIND_PLAIN = 3  # the payload object itself (schemas disabled upstream)


def schema_text(value: Column | str = "value") -> Column:
    """Raw text of the embedded schema, null when absent, null or unparsable."""
    v = F.col(value) if isinstance(value, str) else value
    return F.get_json_object(v, "$.schema")


def event_kind(value: str = "value", schema: Column | None = None) -> Column:
    """Classify each event; the full-text check only runs for rows without a schema."""
    s = schema if schema is not None else schema_text(value)
    keys = F.json_object_keys(F.col(value))
    return (F.when(s.isNotNull(), F.lit(KIND_DECLARED))
            .when(keys.isNull(), F.lit(KIND_MALFORMED))
            .when(F.array_contains(keys, "payload"), F.lit(KIND_ENVELOPED_NO_SCHEMA))
            .otherwise(F.lit(KIND_PLAIN)))


def split_envelope(df: DataFrame, *, keys: bool = True) -> DataFrame:
    """Add ``value_schema``/``payload`` (and ``key_schema``/``key_payload``) text columns.

    One JSON parse per column gives both parts; nested objects come back as
    their JSON text. A value without an envelope is its own payload.
    """
    env = F.from_json(F.col("value"), "schema string, payload string")
    out = df.withColumn("__env", env).withColumn("value_schema", F.col("__env.schema")).withColumn(
        "payload",
        F.when(F.col("__env.payload").isNotNull() | F.col("__env.schema").isNotNull(), F.col("__env.payload"))
        .otherwise(F.when(F.array_contains(F.json_object_keys("value"), "payload"), F.lit(None)).otherwise(F.col("value"))),
    ).drop("__env")
    if keys and "key" in df.columns:
        kenv = F.from_json(F.col("key"), "schema string, payload string")
        out = (out.withColumn("__kenv", kenv).withColumn("key_schema", F.col("__kenv.schema"))
               .withColumn("key_payload", F.coalesce(F.col("__kenv.payload"),
                                                     F.when(F.col("__kenv.schema").isNull(), F.col("key"))))
               .drop("__kenv"))
    return out


def drop_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    """Remove tombstones (they follow deletes): null values, and envelopes whose payload is null.

    Only events with the text of a null payload are parsed to tell.
    """
    v = F.col(value)
    null_payload = v.contains("null") & v.rlike(r'"payload"\s*:\s*null') & F.array_contains(F.json_object_keys(v), "payload") & F.get_json_object(v, "$.payload").isNull()
    return df.filter(v.isNotNull() & ~F.coalesce(null_payload, F.lit(False)))


def include_tables(df: DataFrame, tables: Iterable[str] | None = None, *, pattern: str | None = None,
                   destination: str = "destination") -> DataFrame:
    """Keep only events of the listed destinations, or of those matching a Java regex."""
    cond = F.lit(True)
    if tables is not None:
        cond = cond & F.col(destination).isin(list(tables))
    if pattern is not None:
        cond = cond & F.col(destination).rlike(pattern)
    return df.filter(cond)


def malformed_flag(value: str = "value") -> Column:
    """True for a non-null value that is not one JSON object (text after its end included)."""
    v = F.col(value)
    return v.isNotNull() & (F.json_object_keys(v).isNull() | ~F.rtrim(v).endswith("}"))


def split_malformed(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split events into (parsable, malformed); the second keeps the raw text for quarantine."""
    flagged = df.withColumn("__malformed", malformed_flag(value))
    good = flagged.filter(~F.col("__malformed")).drop("__malformed")
    bad = flagged.filter(F.col("__malformed")).drop("__malformed")
    return good, bad
