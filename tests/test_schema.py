import json

import pytest
from pyspark.sql import types as T

from cdclake.functions.schema import (augment_schema, canonical_schema, connect_schema_to_struct,
                                      inferred_type_to_spark, spark_type_to_connect)


def field(fname, typ, **kw):
    return {"type": typ, "field": fname, "optional": True} | kw


@pytest.mark.parametrize("connect,spark", [
    ("int8", T.IntegerType()), ("int16", T.IntegerType()), ("int32", T.IntegerType()), ("int64", T.LongType()),
    ("float8", T.FloatType()), ("float16", T.FloatType()), ("float32", T.FloatType()), ("float64", T.DoubleType()),
    ("boolean", T.BooleanType()), ("string", T.StringType()), ("bytes", T.BinaryType()),
    ("decimal", T.StringType()), ("something-else", T.StringType()),
])
def test_primitive_mapping(connect, spark):
    s = connect_schema_to_struct({"type": "struct", "fields": [field("x", connect)]})
    assert s == T.StructType([T.StructField("x", spark, True)])


def test_logical_names_are_ignored():
    s = connect_schema_to_struct({"type": "struct", "fields": [
        field("d", "int32", name="io.debezium.time.Date", version=1),
        field("iv", "int64", name="io.debezium.time.MicroDuration"),
        field("ts", "int64", name="io.debezium.time.MicroTimestamp", optional=False),
    ]})
    assert [f.dataType for f in s.fields] == [T.IntegerType(), T.LongType(), T.LongType()]
    assert all(f.nullable for f in s.fields)


def test_null_schema_gives_none():
    assert connect_schema_to_struct(None) is None


def test_flattened_row_fixture_shape():
    schema = {"type": "struct", "name": "testc.inventory.orders.Value", "optional": False, "fields": [
        field("id", "int32", optional=False), field("booked_on", "int32", name="io.debezium.time.Date"),
        field("buyer", "int32"), field("pieces", "int32"), field("item_no", "int32"),
        field("__op", "string"), field("__table", "string"), field("__lsn", "int64"),
        field("__source_ts_ms", "int64"), field("__deleted", "string")]}
    s = augment_schema(connect_schema_to_struct(json.dumps(schema)))
    assert "id:int,booked_on:int,buyer:int,pieces:int,item_no:int,__op:string" in s.simpleString()
    assert s.fieldNames()[-1] == "__source_ts"
    assert s.fieldNames().count("__source_ts_ms") == 1


def test_nested_envelope_fixture_shape():
    row = {"type": "struct", "optional": True, "fields": [field("id", "int32", optional=False),
                                                          field("first_name", "string"), field("last_name", "string"),
                                                          field("email", "string")]}
    source = {"type": "struct", "field": "source", "fields": [
        field("version", "string"), field("connector", "string"), field("name", "string"), field("ts_ms", "int64"),
        field("snapshot", "boolean"), field("db", "string"), field("table", "string"), field("server_id", "int64"),
        field("gtid", "string"), field("file", "string"), field("pos", "int64"), field("row", "int32"),
        field("thread", "int64"), field("query", "string")]}
    env = {"type": "struct", "fields": [row | {"field": "before"}, row | {"field": "after"}, source,
                                        field("op", "string"), field("ts_ms", "int64")]}
    s = augment_schema(connect_schema_to_struct(env))
    cat = s.simpleString()
    assert "before:struct<id" in cat and "after:struct<id" in cat
    assert s["source"].dataType["snapshot"].dataType == T.BooleanType()
    assert s.fieldNames()[-2:] == ["__source_ts", "__source_ts_ms"]


def test_array_and_map_are_typed():
    s = connect_schema_to_struct({"type": "struct", "fields": [
        field("tags", "array", items={"type": "string"}),
        field("nums", "array", items={"type": "int64"}),
        field("untyped", "array"),
        field("attrs", "map", keys={"type": "string"}, values={"type": "float64"}),
        field("nested", "array", items={"type": "struct", "fields": [field("a", "int16")]}),
    ]})
    assert s["tags"].dataType == T.ArrayType(T.StringType())
    assert s["nums"].dataType == T.ArrayType(T.LongType())
    assert s["untyped"].dataType == T.ArrayType(T.StringType())
    assert s["attrs"].dataType == T.MapType(T.StringType(), T.DoubleType())
    assert s["nested"].dataType == T.ArrayType(T.StructType([T.StructField("a", T.IntegerType())]))


def test_augment_replaces_declared_source_ts():
    s = augment_schema(T.StructType([T.StructField("__source_ts", T.LongType()), T.StructField("x", T.IntegerType())]))
    assert s.fieldNames() == ["x", "__source_ts", "__source_ts_ms"]
    assert s["__source_ts"].dataType == T.TimestampType()


def test_canonical_ignores_names_versions_optional():
    a = {"type": "struct", "name": "a.Value", "version": 1, "fields": [field("x", "int32", optional=False)]}
    b = {"type": "struct", "name": "b.Value", "fields": [field("x", "int16", name="n")]}
    c = {"type": "struct", "fields": [field("x", "int64")]}
    assert canonical_schema(a) == canonical_schema(b)
    assert canonical_schema(a) != canonical_schema(c)


def test_spark_to_connect_round_trip():
    st = T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.DoubleType()),
        T.StructField("d", T.StringType()), T.StructField("e", T.BooleanType()), T.StructField("f", T.BinaryType()),
        T.StructField("g", T.ArrayType(T.StringType())), T.StructField("h", T.MapType(T.StringType(), T.LongType())),
        T.StructField("i", T.StructType([T.StructField("j", T.FloatType())])),
    ])
    assert connect_schema_to_struct(spark_type_to_connect(st)) == st
    assert spark_type_to_connect(T.DateType()) ["type"] == "int32"
    assert spark_type_to_connect(T.TimestampNTZType())["type"] == "int64"
    assert spark_type_to_connect(T.DecimalType(18, 4))["type"] == "float64"


def test_inferred_types_follow_json_reader():
    dt = T.StructType([T.StructField("a", T.DecimalType(2, 1)), T.StructField("b", T.DecimalType(10, 0)),
                       T.StructField("c", T.DecimalType(25, 0)), T.StructField("d", T.NullType()),
                       T.StructField("e", T.ArrayType(T.DecimalType(3, 0)))])
    out = inferred_type_to_spark(dt)
    assert [f.dataType for f in out.fields] == [T.DoubleType(), T.LongType(), T.DecimalType(38, 0), T.StringType(),
                                                T.ArrayType(T.LongType())]
