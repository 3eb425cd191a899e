import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake import (add_source_ts, cast_deleted, decode_key, decode_payload, drop_tombstones, include_tables,
                     normalize_source, snapshot_as_insert, split_envelope, split_malformed, unwrap)
from cdclake.functions import (deleted_as_bool, map_destination, partition_date, partition_date_text, source_ts,
                               target_path, target_path_text, write_id)
from cdclake.functions.schema import connect_schema_to_struct
from cdclake.plans.ingest import decode_events
from helpers import events, flat, fld, value

CUST = [fld("id", "int32", optional=False), fld("first_name", "string"), fld("last_name", "string"),
        fld("email", "string")]


def test_split_envelope_payload_and_schema(spark):
    v = value(CUST, {"id": 1004, "first_name": "Anne", "last_name": "K", "email": "a@x"})
    k = value([fld("id", "int32")], {"id": 1004}, name="Key")
    df = split_envelope(events(spark, [("d", k, v), ("d", None, '{"id":5}')]))
    r = df.collect()
    assert json.loads(r[0]["payload"]) == {"id": 1004, "first_name": "Anne", "last_name": "K", "email": "a@x"}
    assert json.loads(r[0]["value_schema"])["fields"][0]["field"] == "id"
    assert json.loads(r[0]["key_payload"]) == {"id": 1004}
    assert r[1]["value_schema"] is None and json.loads(r[1]["payload"]) == {"id": 5}


def test_drop_tombstones_and_include(spark):
    df = events(spark, [("a", None, "{}"), ("a", None, None), ("b", None, "{}"), ("c", None, "{}")])
    assert drop_tombstones(df).count() == 3
    assert include_tables(df, ["a", "c"]).count() == 3
    assert include_tables(df, pattern="^[ab]$").count() == 3


def test_split_malformed(spark):
    good = flat(CUST, {"id": 1, "first_name": "a", "last_name": "b", "email": None})
    df = events(spark, [("t", None, good), ("t", None, good[: len(good) // 2]), ("t", None, "nope"),
                        ("t", None, None)])
    ok, bad = split_malformed(df)
    assert ok.count() == 2 and bad.count() == 2


def test_decode_declared_missing_and_extra_fields(spark):
    fields = [fld("id", "int32"), fld("name", "string"), fld("age", "int32")]
    df = events(spark, [("t", None, value(fields, {"id": 1, "name": "x", "extra": 5})),
                        ("t", None, value(fields, {"id": 2, "name": None, "age": "notint"}))])
    out = decode_payload(df, connect_schema_to_struct({"type": "struct", "fields": fields}))
    assert out.columns == ["id", "name", "age"]
    rows = sorted(out.collect())
    assert rows[0] == (1, "x", None)
    assert rows[1] == (2, None, None)


def test_data_type_matrix(spark):
    fields = [fld("c_id", "int32"), fld("c_text", "string"), fld("c_varchar", "string"), fld("c_int", "int32"),
              fld("c_date", "int32", name="io.debezium.time.Date"),
              fld("c_timestamp", "int64", name="io.debezium.time.MicroTimestamp"),
              fld("c_timestamptz", "string", name="io.debezium.time.ZonedTimestamp"),
              fld("c_float", "float32"), fld("c_decimal", "float64"), fld("c_numeric", "float64"),
              fld("c_interval", "int64", name="io.debezium.time.MicroDuration"), fld("c_boolean", "boolean"),
              fld("c_uuid", "string", name="io.debezium.data.Uuid"), fld("c_bytea", "bytes"),
              fld("c_json", "string", name="io.debezium.data.Json"), fld("c_jsonb", "string")]
    filled = {"c_id": 2, "c_text": "jhgjhg", "c_varchar": "hjhjgjhg", "c_int": 123, "c_date": 19000,
              "c_timestamp": 1_640_995_200_000_000, "c_timestamptz": "2022-01-01T00:00:00Z", "c_float": 1.23,
              "c_decimal": 8812.0625, "c_numeric": 77.125, "c_interval": 5_400_000_000, "c_boolean": True,
              "c_uuid": "f4b4c4e4-0000-4000-8000-000000000000", "c_bytea": base64.b64encode(b"Zq9").decode(),
              "c_json": '{"a":1}', "c_jsonb": '{"b":2}'}
    null_row = {k: None for k in filled} | {"c_id": 1}
    df = events(spark, [("t.dt", None, flat(fields, null_row)), ("t.dt", None, flat(fields, filled))])
    (g, out), = decode_events(df)
    r = out.filter("c_id = 2").first()
    assert bytes(r["c_bytea"]) == b"Zq9"
    assert r["c_float"] == pytest.approx(1.23, rel=1e-6)
    assert r["c_decimal"] == 8812.0625 and r["c_numeric"] == 77.125
    assert r["c_interval"] == 5_400_000_000 and r["c_boolean"] is True
    assert out.filter("c_id = 1").filter("c_uuid is null and c_timestamp is null and c_bytea is null").count() == 1
    casts = out.filter("c_id = 2").select(F.col("c_bytea").cast("string"), F.col("c_decimal").cast("float")).first()
    assert casts[0] == "Zq9"
    assert out.schema["__source_ts"].dataType == T.TimestampType()


def test_inferred_decode(spark):
    df = events(spark, [("t", None, '{"a":1,"b":"x","c":2.5}'), ("t", None, '{"a":3000000000,"d":true,"c":3}'),
                        ("t", None, '{"schema":null,"payload":{"a":7}}')])
    groups = decode_events(df)
    kinds = {g.kind: out for g, out in groups}
    plain = kinds[3]
    assert dict((f.name, f.dataType) for f in plain.schema.fields if not f.name.startswith("__")) == {
        "a": T.LongType(), "b": T.StringType(), "c": T.DoubleType(), "d": T.BooleanType()}
    assert sorted(r["a"] for r in plain.collect()) == [1, 3000000000]
    assert kinds[2].select("a").first()[0] == 7


def test_inferred_source_ts_presence(spark):
    df = events(spark, [("t", None, '{"a":1,"__source_ts_ms":1600000000999}'), ("t", None, '{"a":2}'),
                        ("t", None, '{"a":3,"__source_ts_ms":null}')])
    (g, out), = decode_events(df, batch_time_ms=1_700_000_000_500)
    got = {r["a"]: (r["__source_ts_ms"], r["__source_ts"]) for r in out.collect()}
    assert got[1] == (1600000000999, dt.datetime(2020, 9, 13, 12, 26, 40))
    assert got[2][0] == 1_700_000_000_500
    assert got[3] == (None, None)


def test_unwrap_update_delete_insert(spark):
    row = {"type": "struct", "optional": True, "fields": CUST}
    source = {"type": "struct", "field": "source", "fields": [
        fld("connector", "string"), fld("db", "string"), fld("table", "string"), fld("ts_ms", "int64"),
        fld("lsn", "int64"), fld("txId", "int64")]}
    fields = [row | {"field": "before"}, row | {"field": "after"}, source, fld("op", "string"),
              fld("ts_ms", "int64")]
    src = {"connector": "postgresql", "db": "inventory", "table": "customers", "ts_ms": 1000, "lsn": 77, "txId": 5}
    a = {"id": 1, "first_name": "A", "last_name": "B", "email": "e"}
    b = a | {"first_name": "Ada-renamed"}
    evs = [value(fields, {"before": None, "after": a, "source": src, "op": "c", "ts_ms": 2}),
           value(fields, {"before": a, "after": b, "source": src, "op": "u", "ts_ms": 3}),
           value(fields, {"before": b, "after": None, "source": src, "op": "d", "ts_ms": 4})]
    df = events(spark, [("x", None, v) for v in evs])
    (g, env), = decode_events(df)
    flat_df = unwrap(env, ["op", "table", "lsn", "source.ts_ms", "source.txId", "db", "file"])
    assert flat_df.columns == ["id", "first_name", "last_name", "email", "__op", "__table", "__lsn",
                               "__source_ts_ms", "__source_txId", "__db", "__file", "__deleted"]
    got = sorted((r["__op"], r["first_name"], r["__deleted"], r["__lsn"], r["__file"]) for r in flat_df.collect())
    assert got == [("c", "A", "false", 77, None), ("d", "Ada-renamed", "true", 77, None),
                   ("u", "Ada-renamed", "false", 77, None)]


def test_snapshot_as_insert(spark):
    df = spark.createDataFrame([("r",), ("c",), ("d",)], "__op string")
    assert sorted(r[0] for r in snapshot_as_insert(df).collect()) == ["c", "c", "d"]


def test_add_source_ts_variants(spark):
    df = spark.createDataFrame([(1, 1_600_000_000_999), (2, None), (3, -1500)], "id int, __source_ts_ms bigint")
    out = add_source_ts(df, 0)
    assert out.columns == ["id", "__source_ts_ms", "__source_ts"]
    got = {r["id"]: r["__source_ts"] for r in out.collect()}
    assert got[1] == dt.datetime(2020, 9, 13, 12, 26, 40)
    assert got[2] is None
    assert got[3] == dt.datetime(1969, 12, 31, 23, 59, 59)  # truncation toward zero: -1500 ms -> -1 s
    legacy = {r["id"]: r["__source_ts"] for r in add_source_ts(df, 0, legacy_null_ts=True).collect()}
    assert legacy[2] == dt.datetime(1970, 1, 1)
    none = add_source_ts(spark.createDataFrame([(1,)], "id int"), 1_700_000_000_999)
    assert none.columns == ["id", "__source_ts", "__source_ts_ms"]
    assert none.first()[2] == 1_700_000_000_999


def test_cast_deleted(spark):
    df = spark.createDataFrame([("true",), ("false",), ("x",), (None,)], "__deleted string")
    assert [r[0] for r in cast_deleted(df).collect()] == [True, False, None, None]
    assert cast_deleted(spark.createDataFrame([(1,)], "a int")).columns == ["a"]


def test_normalize_source_unions_dialects(spark):
    pg = spark.createDataFrame([(1, ("postgresql", "inv", "public", "t", 5, "true", 9, 99, None))],
                               "id int, source struct<connector:string, db:string, schema:string, table:string, "
                               "ts_ms:bigint, snapshot:string, txId:bigint, lsn:bigint, xmin:bigint>")
    my = spark.createDataFrame([(2, ("mysql", "inv", "t", 6, False, "bin.3", 154, 0, 223344))],
                               "id int, source struct<connector:string, db:string, table:string, ts_ms:bigint, "
                               "snapshot:boolean, file:string, pos:bigint, row:int, server_id:bigint>")
    u = normalize_source(pg).unionByName(normalize_source(my))
    got = {r["id"]: r["source_position"] for r in u.collect()}
    assert got[1]["lsn"] == 99 and got[1]["binlog_file"] is None and got[1]["snapshot"] == "true"
    assert got[2]["binlog_pos"] == 154 and got[2]["lsn"] is None and got[2]["snapshot"] == "false"


def test_decode_key(spark):
    k = value([fld("id", "int32"), fld("id2", "int32")], {"id": 1, "id2": 2}, name="Key")
    out = decode_key(events(spark, [("t", k, "{}")]), keep=("destination",))
    assert out.first()["key_struct"].asDict() == {"id": 1, "id2": 2}


def test_column_functions(spark):
    df = spark.createDataFrame([("shop.sales.buyers", 1_700_000_000_000, "part-00003-123e4567-e89b-12d3-a456-426614174000-c000.snappy.parquet")],
                               "d string, ms bigint, f string")
    r = df.select(map_destination("d", r"^shop\.(\w+)\.(\w+)$", "$2_$1").alias("m"),
                  map_destination("d").alias("same"),
                  target_path("d", "s3a://b/", "pre_", r"^shop\.", "").alias("p"),
                  partition_date("ms", "UTC").alias("dt"), partition_date("ms", "Asia/Tokyo").alias("dt_tokyo"),
                  write_id("f").alias("w"), source_ts("ms").alias("ts"), deleted_as_bool(F.lit("TRUE")).alias("b")).first()
    assert r["m"] == "buyers_sales" and r["same"] == "shop.sales.buyers"
    assert r["p"] == "s3a://b/pre_sales.buyers"
    assert r["dt"] == "dt=2023-11-14" == partition_date_text(1_700_000_000_000, "UTC")
    assert r["dt_tokyo"] == partition_date_text(1_700_000_000_000, "Asia/Tokyo") == "dt=2023-11-15"
    assert r["w"] == "123e4567-e89b-12d3-a456-426614174000"
    assert r["b"] is True
    assert target_path_text("shop.sales.buyers", "s3a://b", "pre_", r"^shop\.(\w+)\.(\w+)$", "$2",
                            "dt=2024-01-01") == "s3a://b/pre_buyers/dt=2024-01-01"


def test_null_destination_path_fails(spark):
    df = spark.createDataFrame([(None,)], "d string")
    with pytest.raises(Exception):
        df.select(target_path("d", "s3a://b")).collect()
    with pytest.raises(ValueError):
        target_path_text(None, "s3a://b")


def test_inferred_conflicting_types_become_strings(spark):
    df = events(spark, [("t", None, '{"a":1,"b":{"x":1},"c":[1,2]}'), ("t", None, '{"a":"x","b":5,"c":["y"]}')])
    (g, out), = decode_events(df)
    types = dict(out.dtypes)
    assert types["a"] == "string" and types["b"] == "string"
    got = sorted(r["a"] for r in out.collect())
    assert got == ["1", "x"]


def test_add_headers_map_and_kafka_shapes(spark):
    from cdclake.operators.transform import add_headers

    m = spark.createDataFrame([(1, {"__db": "inv"}), (2, None)], "id int, headers map<string,string>")
    assert [tuple(r) for r in add_headers(m, ["db", "tx"]).orderBy("id").collect()] == [(1, "inv", None),
                                                                                       (2, None, None)]
    k = spark.createDataFrame([(1, [("__db", b"a"), ("__db", b"b")]), (2, [])],
                              "id int, headers array<struct<key:string, value:binary>>")
    out = add_headers(k.select("id", F.transform("headers", lambda h: F.struct(
        h["key"].alias("key"), h["value"].cast("string").alias("value"))).alias("headers")), ["db"])
    assert out.columns == ["id", "__db"] and [r["__db"] for r in out.orderBy("id").collect()] == ["b", None]
    p = spark.createDataFrame([(1, "payload", {"__db": "hdr"})], "id int, __db string, headers map<string,string>")
    assert add_headers(p, ["db"]).first()["__db"] == "payload"  # a payload field wins


def test_config_reads_add_headers():
    from cdclake import CdcConfig

    cfg = CdcConfig.from_properties({"debezium.transforms.unwrap.add.headers": "db, table"}, base_path="/x")
    assert cfg.header_fields == ("db", "table")


def test_normalize_source_four_connectors(spark):
    from cdclake.sources.encode import encode_events

    df = spark.range(1, 9).select(F.col("id").alias("k"))
    dialect = F.element_at(F.array(*[F.lit(c) for c in ("postgresql", "mysql", "sqlserver", "mongodb")]),
                           (F.col("k") % 4 + 1).cast("int"))
    groups = decode_events(encode_events(df, "s.db.t", style="envelope", connector=dialect, lsn=F.col("k")))
    assert len(groups) == 4
    rows = {r["connector"]: r for r in union_rows([normalize_source(d).select("source_position.*") for _, d in groups])}
    assert set(rows) == {"postgresql", "mysql", "sqlserver", "mongodb"}
    assert rows["sqlserver"]["change_lsn"] is not None and rows["sqlserver"]["schema"] == "dbo"
    assert rows["mongodb"]["replica_set"] == "rs0" and rows["mongodb"]["table"] == "t"
    assert rows["mysql"]["binlog_file"] is not None and rows["postgresql"]["lsn"] is not None


def union_rows(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.collect()
