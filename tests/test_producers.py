"""Events of other producers, misfits, replays of two streams, keys of several types, swapped compactions."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cdclake import CdcConfig, batch_utilisation, compact_partition, ingest_batch, read_table
from cdclake.operators.decode import decode_key
from cdclake.operators.transform import add_source_ts, unwrap
from cdclake.plans.compact import commit_compaction
from cdclake.plans.ingest import _PATH_LOCKS, decode_events, input_partitions, stable_batch_time
from helpers import events, flat, fld, value

FIELDS = [fld("id", "int64"), fld("n", "int32")]


def test_blanks_and_member_order_do_not_split_a_group(spark):
    def texts(i):
        e = json.loads(flat(FIELDS, {"id": i, "n": i}))
        yield json.dumps(e)
        yield json.dumps(e, separators=(",", ":"))
        yield json.dumps(e, indent=2)
        yield json.dumps({"payload": e["payload"], "ts": 1, "schema": e["schema"]})

    rows = [("t", None, x) for i in range(5) for x in texts(i)]
    (group, df), = decode_events(events(spark, rows))
    assert group.rows == 20 and sorted(r["id"] for r in df.collect()) == sorted(list(range(5)) * 4)


def test_a_decoded_batch_deletes_its_staged_table(spark):
    with decode_events(events(spark, [("t", None, flat(FIELDS, {"id": 1, "n": 1}))])) as groups:
        path = groups.path.removeprefix("file:")
        assert os.path.isdir(path) and groups[0][1].count() == 1
    assert not os.path.exists(path) and groups.path is None


def test_fields_of_the_wrong_type_are_null_or_quarantined(spark, lake):
    good, null = flat(FIELDS, {"id": 1, "n": 1}), json.loads(flat(FIELDS, {"id": 1, "n": 1})) | {"payload": None}
    bad = flat(FIELDS, {"id": "abc", "n": 7})
    ev = events(spark, [("t", None, x) for x in (good, bad, good + " x", json.dumps(null))])
    res = ingest_batch(events(spark, [("t", None, good), ("t", None, bad), ("t", None, json.dumps(null))]), CdcConfig(base_path=f"{lake}/f"), batch_id=0)
    assert res.rows == 2 and sorted((r["id"], r["n"]) for r in read_table(spark, f"{lake}/f/t").collect() if r["id"]) == [(1, 1)]
    res = ingest_batch(ev, CdcConfig(base_path=f"{lake}/q", on_malformed="quarantine"), batch_id=0)
    assert res.rows == 1 and [r["id"] for r in read_table(spark, f"{lake}/q/t").collect()] == [1]
    kept = spark.read.json(f"{lake}/q/_quarantine/t").select("value").collect()
    assert sorted(r["value"] for r in kept) == sorted([bad, good + " x"])


def test_an_event_cut_inside_its_schema_fails_by_name(spark, lake):
    with pytest.raises(ValueError, match="malformed change event"):
        ingest_batch(events(spark, [("t", None, flat(FIELDS, {"id": 1, "n": 1})[:40])]), CdcConfig(base_path=lake), batch_id=0)


def test_two_streams_with_equal_batch_ids_keep_their_rows(spark, lake):
    for stream, ids in (("a", range(10)), ("b", range(100, 105)), ("b", range(100, 105))):
        cfg = CdcConfig(base_path=lake, idempotent=True, partition=True, stream_id=stream)
        ingest_batch(events(spark, [("t", None, flat(FIELDS, {"id": i, "n": 0})) for i in ids]), cfg, batch_id=0, batch_time_ms=1)
    assert sorted(r["id"] for r in read_table(spark, f"{lake}/t").collect()) == [*range(10), *range(100, 105)]
    with pytest.raises(ValueError, match="stream id"):
        ingest_batch(events(spark, [("t", None, "{}")]), CdcConfig(base_path=lake, idempotent=True), batch_id=0)


def test_a_batch_time_that_was_not_written_out_is_recorded_anew(spark, tmp_path):
    folder = tmp_path / "_batch_times" / "s"
    folder.mkdir(parents=True)
    (folder / "4").write_text("")
    assert stable_batch_time(spark, str(tmp_path), "s", 4, 77) == 77
    assert stable_batch_time(spark, str(tmp_path), "s", 4, 99) == 77
    assert [x for x in os.listdir(folder) if not x.startswith(".")] == ["4"]


def test_keys_of_one_name_and_several_types(spark):
    def key(typ, v):
        return value([fld("id", typ)], {"id": v})

    rows = [("a", key("int32", 5), None), ("b", key("int64", 9_999_999_999), None), ("c", json.dumps({"id": 7}), None), ("d", None, None)]
    got = {r["destination"]: r["key_struct"] for r in decode_key(events(spark, rows), keep=("destination",)).collect()}
    assert got["a"]["id"] == 5 and got["b"]["id"] == 9_999_999_999 and got["c"]["id"] == 7 and got["d"] is None
    rows.append(("e", key("string", "x-1"), None))
    got = {r["destination"]: r["key_struct"] for r in decode_key(events(spark, rows), keep=("destination",)).collect()}
    assert got["b"]["id"] == "9999999999" and got["e"]["id"] == "x-1"
    with pytest.raises(ValueError, match="max_schemas"):
        decode_key(events(spark, rows), max_schemas=2)


def test_names_with_dots_and_fixed_types_of_added_fields(spark):
    df = spark.sql("SELECT named_struct('a.b', 1) AS after, named_struct('a.b', 1) AS before, named_struct('db', 'x') AS source, 'c' AS op")
    out = add_source_ts(unwrap(df, ("op", "lsn", "source.pos", "source.row", "db")), 1000)
    assert out.columns[0] == "a.b" and out.first()["a.b"] == 1
    types = dict(out.dtypes)
    assert (types["__lsn"], types["__source_pos"], types["__source_row"], types["__db"]) == ("bigint", "bigint", "int", "string")


def test_properties_reach_the_transform_and_the_table_list():
    props = {"debezium.transforms": "unwrap", "debezium.transforms.unwrap.type": "x.ExtractNewRecordState", "debezium.transforms.unwrap.add.fields": "op, source.pos",
             "debezium.source.table.include.list": "inv.a,inv.b", "debezium.source.database.server.name": "s"}
    cfg = CdcConfig.from_properties(props, base_path="/x")
    assert cfg.unwrap and cfg.add_fields == ("op", "source.pos") and cfg.include_tables == ("s.inv.a", "s.inv.b")
    assert not CdcConfig.from_properties({}, base_path="/x").unwrap


def test_compaction_with_maps_is_hidden_until_it_is_committed(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(100).select("id", F.create_map(F.lit("k"), F.col("id"), F.lit("a"), F.lit(1)).alias("m.x"), F.lit("2023-11-14").alias("dt"))
    df.repartition(6).write.partitionBy("dt").parquet(root)
    part = compact_partition(spark, f"{root}/dt=2023-11-14", files=1)
    t = read_table(spark, root)
    assert t.count() == 100 and dict(t.dtypes)["dt"] == "date"
    commit_compaction(spark, part)
    t = read_table(spark, root)
    assert t.count() == 100 and t.select("input_file").distinct().count() == 1 and t.where("dt = DATE'2023-11-14'").count() == 100
    with pytest.raises(FileNotFoundError):
        commit_compaction(spark, part)
    df.write.mode("append").parquet(f"{root}/dt=2023-11-15/batch_id=3")
    with pytest.raises(ValueError, match="partition levels"):
        compact_partition(spark, root)


def test_utilisation_sums_a_batch_first(spark):
    log = spark.createDataFrame([(b, "d", 50) for b in range(3) for _ in range(2)], "batch_id bigint, destination string, rows bigint")
    for partition in ("destination", None):
        out = {r["batch_id"]: r for r in batch_utilisation(log, 100, partition=partition).collect()}
        assert out[2]["avg3"] == 100 and out[2]["band"] == ">=97%"


def test_partition_counts_never_run_a_shuffle_and_locks_go(spark, lake):
    assert input_partitions(spark.range(10).groupBy(F.col("id") % 3).count()) is None
    assert input_partitions(spark.range(0, 10, 1, 3)) == 3
    ingest_batch(events(spark, [("t", None, flat(FIELDS, {"id": 1, "n": 1}))]), CdcConfig(base_path=lake), batch_id=0)
    assert f"{lake}/t" not in _PATH_LOCKS
