"""Typed decoding of event payloads: declared schema or inferred schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import SOURCE_TS, connect_schema_to_struct, inferred_type_to_spark
from ..sources.tables import widen_types


def _decode_struct(struct: T.StructType) -> T.StructType:
    # ``__source_ts`` is always recomputed from ``__source_ts_ms``.
    return T.StructType([f for f in struct.fields if f.name != SOURCE_TS])


CORRUPT = "__corrupt"


def decode_payload(df: DataFrame, struct: T.StructType | None, *, value: str = "value", enveloped: bool = True,
                   corrupt: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``value`` into typed columns.

    A field whose text does not fit its type is null, as with the JSON
    reader's default mode. ``corrupt`` adds the boolean ``__corrupt``: true for rows with such a
    field, from the same parse.

    ``struct`` given: one ``from_json`` straight from the event text (no
    intermediate payload string). ``None``: infer the payload schema first
    (one aggregation job over the frame) and then parse.
    Fields missing from the payload are null; extra payload fields are dropped.
    """
    if struct is None:
        struct = infer_payload_schema(df, value=value, enveloped=enveloped)
    struct = _decode_struct(struct)
    whole = T.StructType([T.StructField("payload", struct, True)]) if enveloped else struct
    opts = {}
    if corrupt:
        whole = T.StructType([*whole.fields, T.StructField(CORRUPT, T.StringType(), True)])
        opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    flag = [F.col("__event").getField(CORRUPT).isNotNull().alias(CORRUPT)] if corrupt else []
    out = df.select(*keep, F.from_json(F.col(value), whole, opts).alias("__event"))
    row = F.col("__event").getField("payload") if enveloped else F.col("__event")
    return out.select(*keep, *flag, *[row.getField(f.name).alias(f.name) for f in struct.fields])


def payload_variant(value: str = "value", enveloped: bool = True, tolerant: bool = False) -> Column:
    v = (F.try_parse_json if tolerant else F.parse_json)(F.col(value))
    return F.variant_get(v, "$.payload", "variant") if enveloped else v


def _struct_from_ddl(spark, ddl: str) -> T.StructType:
    # Parse the DDL through a typed empty projection; public API only.
    dt = spark.range(0).select(F.from_json(F.lit(""), ddl).alias("x")).schema["x"].dataType
    return dt


def infer_payload_schema(df: DataFrame, *, value: str = "value", enveloped: bool = True) -> T.StructType:
    """Infer the payload schema of all rows (merged across rows, JSON-reader types).

    Runs as a distributed aggregate (``schema_of_variant_agg`` merges partial
    schemas per partition), so only one schema string reaches the driver.
    """
    row = df.select(F.schema_of_variant_agg(payload_variant(value, enveloped)).alias("s")).first()
    ddl = row["s"] if row is not None else None
    if not ddl or not ddl.startswith("OBJECT<"):
        return T.StructType([])
    return inferred_ddl_to_struct(df.sparkSession, ddl)


def inferred_ddl_to_struct(spark, ddl: str) -> T.StructType:
    import re

    spark_ddl = re.sub(r"(?<![`\w])OBJECT<", "STRUCT<", ddl)
    return inferred_type_to_spark(_struct_from_ddl(spark, spark_ddl))


def _meet(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that values of both read into: the widened type, else their text."""
    try:
        return widen_types(a, b)
    except ValueError:
        return T.StringType()


def decode_key(df: DataFrame, *, key: str = "key", keep: tuple[str, ...] = (), max_schemas: int = 1000) -> DataFrame:
    """Decode the event key with its embedded key schema into a ``key_struct`` column.

    Distinct key schemas are few (one per table version, at most
    ``max_schemas``); each is compiled once on the driver, texts that compile to one type share
    a parse, and every row is parsed with the schema of its own text, or with the inferred one if it
    has none. Key fields of one name in several schemas meet in the widened type,
    or in text if there is none, so no value is lost.
    """
    text = F.get_json_object(F.col(key), "$.schema")
    texts = [r[0] for r in df.where(F.col(key).isNotNull()).select(text.alias("s")).distinct().limit(max_schemas + 1).collect()]
    if len(texts) > max_schemas:
        raise ValueError(f"more than {max_schemas} distinct key schemas in one frame; raise max_schemas")
    structs: dict[str | None, T.StructType] = {t: connect_schema_to_struct(t) for t in sorted(t for t in texts if t is not None)}
    if None in texts:
        plain = df.where(F.col(key).isNotNull() & text.isNull())
        structs[None] = infer_payload_schema(plain, value=key, enveloped=False)
    types: dict[str, T.DataType] = {}
    for struct in structs.values():
        for f in struct.fields:
            types[f.name] = _meet(types[f.name], f.dataType) if f.name in types else f.dataType
    if not types:
        return df.select(*keep, F.lit(None).cast(T.StructType([])).alias("key_struct"))
    parsed = F.lit(None).cast(T.StructType([T.StructField(n, t, True) for n, t in types.items()]))
    alike: dict[str | None, list[str]] = {}
    for schema, struct in structs.items():
        alike.setdefault(None if schema is None else struct.json(), []).append(schema)
    for members in alike.values():
        struct, enveloped = structs[members[0]], members[0] is not None
        row = F.from_json(F.col(key), T.StructType([T.StructField("payload", struct, True)]) if enveloped else struct)
        row = row.getField("payload") if enveloped else row
        have = {f.name for f in struct.fields}
        fields = [(row.getField(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in types.items()]
        mine = text.isin(members) if enveloped else text.isNull()
        parsed = F.when(mine & row.isNotNull(), F.struct(*fields)).otherwise(parsed)
    return df.select(*keep, F.when(F.col(key).isNotNull(), parsed).alias("key_struct"))
