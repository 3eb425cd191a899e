"""Parts, tasks and batches follow the size of the input."""
import json

import pytest
from pyspark.sql import functions as F

from cdclake import CdcConfig, ingest_batch, read_table
from cdclake import workloads
from cdclake.operators.envelope import drop_tombstones
from cdclake.plans import ingest
from cdclake.plans.ingest import BARE, bare_values, key_events, whole_value

SCHEMA = {"type": "struct", "optional": False, "fields": [{"field": "id", "type": "int64"}, {"field": "s", "type": "string"}]}


def event(payload: str) -> str:
    return '{"schema":' + json.dumps(SCHEMA, separators=(",", ":")) + ',"payload":' + payload + "}"


def table_of(spark, folder, n: int):
    spark.range(n).select(F.col("id").alias("o_orderkey")).repartition(1).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_source_parts_follow_rows(spark, tmp_path, monkeypatch):
    """The parts of a table follow its rows, not the task slots."""
    monkeypatch.setattr(workloads, "PART_ROWS", 100)
    folder = table_of(spark, tmp_path, 2000)
    df = workloads.source_rows(spark, folder, "orders")
    assert df.rdd.getNumPartitions() == 20
    assert df.count() == 2000 and df.distinct().count() == 2000


def test_filters_stay_above_the_spread(spark, tmp_path):
    """Encoding and the filters on it run in the spread parts, not in the scan's."""
    df = workloads.source_rows(spark, table_of(spark, tmp_path, 50), "orders").repartition(9)
    ev = drop_tombstones(workloads.encode_events(workloads.source_rows(spark, str(tmp_path), "orders"), "a.b.orders"))
    plan = ev._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") < plan.index("Exchange") and "Filter" not in plan[plan.index("Exchange"):].split("FileScan")[0]
    assert df.count() == 50


VALUES = [event('{"id":1,"s":"a"}'), event('{"id":1.50,"s":"\\u00e9 \\" }"}') + " trailing", event('{"id":"x","s":null}')[:-3],
          '{"payload":{"id":3,"s":"p"},"schema":' + json.dumps(SCHEMA) + "}", event('{"id":2,"s":"ü€𝄞"}').replace(":", ": ", 1),
          '{"schema":null,"payload":{"id":4}}', '{"id":5}', "not json", "", event('{"id":6}') + "\n"]


@pytest.mark.parametrize("strict", [False, True])
def test_bare_values_come_back_whole(spark, strict):
    """A value held without its schema is given back as it came; any other is held as it is."""
    ev = spark.createDataFrame([(i, "d", None, v) for i, v in enumerate(VALUES)], "i int, destination string, key string, value string")
    keyed = key_events(ev.select("destination", "key", "value"), check_malformed=strict)
    rows = bare_values(keyed).select(whole_value(), BARE, F.octet_length("value").alias("n"), "kind").collect()
    assert sorted(r["value"] for r in rows) == sorted(VALUES)
    by_value = {r["value"]: r for r in rows}
    assert by_value[VALUES[0]][BARE] and by_value[VALUES[0]]["n"] == len('{"payload":{"id":1,"s":"a"}}')
    assert not by_value[VALUES[3]][BARE] and not by_value["not json"][BARE]


def test_quarantined_values_are_whole(spark, lake):
    bad = event('{"id":"none","s":"a"}')
    ev = spark.createDataFrame([("t.a", None, bad), ("t.a", None, event('{"id":7,"s":"b"}'))], "destination string, key string, value string")
    ingest_batch(ev, CdcConfig(base_path=lake, on_malformed="quarantine"), batch_time_ms=0)
    assert [r["value"] for r in spark.read.json(f"{lake}/_quarantine/t.a").collect()] == [bad]
    assert [r["id"] for r in read_table(spark, f"{lake}/t.a").collect()] == [7]


@pytest.mark.parametrize("storage", ["cache", "table"])
def test_writing_tasks_follow_bytes(spark, lake, monkeypatch, storage):
    """Few rows of large texts are written by many tasks, and a small table isn't read from the whole cache by one."""
    monkeypatch.setattr(ingest, "TASK_BYTES", 50_000)
    big = spark.range(0, 40, 1, 8).select(F.lit("t.big").alias("destination"), F.lit(None).cast("string").alias("key"),
                                          F.concat(F.lit(event('{"id":')[:-1]), "id", F.lit(',"s":"'), F.repeat(F.sha2(F.col("id").cast("string"), 256), 200), F.lit('"}}')).alias("value"))
    small = spark.range(3).select(F.lit("t.small").alias("destination"), F.lit(None).cast("string").alias("key"),
                                  F.concat(F.lit(event('{"id":')[:-1]), "id", F.lit(',"s":"x"}}')).alias("value"))
    ingest_batch(big.union(small), CdcConfig(base_path=lake, batch_storage=storage), batch_time_ms=0)
    t = read_table(spark, f"{lake}/t.big")
    assert t.select("id").distinct().count() == t.count() == 40
    if storage == "cache":
        assert t.select("input_file").distinct().count() > 4
    s = read_table(spark, f"{lake}/t.small")
    assert sorted(r["id"] for r in s.collect()) == [0, 1, 2] and s.select("input_file").distinct().count() == 1


def test_stream_batches_have_many_files(spark, tmp_path, monkeypatch):
    """A stream's batches stay as many, their files follow the tables' size."""
    monkeypatch.setattr(workloads, "PART_ROWS", 100)
    folder = table_of(spark, tmp_path, 1000)
    ev = workloads.encode_events(spark.read.parquet(f"{folder}/orders.parquet"), "a.b.orders")
    policy = workloads.write_stream_files(spark, folder, ev, f"{folder}/src", 2, "orders")
    assert len(list((tmp_path / "src").glob("part-*.json"))) == 10
    assert policy.source_options("json")["maxFilesPerTrigger"] in (5, "5")


@pytest.mark.parametrize("partitions", ["2", "9"])
def test_dealt_parts_are_kept(spark, tmp_path, monkeypatch, partitions):
    """Events that were dealt into many parts are not dealt again into one per slot, however narrow the session's shuffles are."""
    monkeypatch.setattr(workloads, "PART_ROWS", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        ev = workloads.encode_events(workloads.source_rows(spark, table_of(spark, tmp_path, 2000), "orders"), "a.b.orders")
        assert ingest.dealt_partitions(ev) == 20 and ingest.spread(drop_tombstones(ev), None).rdd.getNumPartitions() == 20
        assert ingest.spread(ev.union(ev), None).rdd.getNumPartitions() == 40
        counted = ev.groupBy("destination").count()
        assert ingest.dealt_partitions(counted) == 0 and ingest.dealt_partitions(spark.range(3)) == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_filters_do_not_encode_again(spark):
    """Text is encoded once a row: a filter on it is not copied below the projection that encodes."""
    ev = drop_tombstones(workloads.encode_events(spark.range(5).withColumn("s", F.lit("payload")), "a.b.c", key=["id"], tombstones=True))
    plan = ev._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('"a.b.c"') == 0 and plan.count("{\"schema\":") == 2  # the key's and the value's
    assert ev.count() == 5
    odd = workloads.encode_events(spark.range(6), "a.b.c").where(F.get_json_object("value", "$.payload.id").cast("int") % 2 == 1)
    assert odd._jdf.queryExecution().optimizedPlan().toString().count("{\"schema\":") == 1 and odd.count() == 3


def test_listing_counts_data_files(spark, tmp_path):
    """Compaction lists by one job, not by calls for each file (F7 F15): odd names, hidden files and folders, levels."""
    from cdclake.plans.compact import _listing_with_partitions

    root = tmp_path / "a b%20ü" / "t=1"
    sizes = {"dt=2024-01-01/x=a b/part-0": 3, "dt=2024-01-02/x=_b/part%201;": 5, "dt=2024-01-02/x=c/_metadata": 7, "dt=2024-01-02/x=c/.part.crc": 9, "_SUCCESS": 1, "_old/dt=1/part-9": 11}
    for name, size in sizes.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * size)
    assert _listing_with_partitions(spark, str(root)) == (2, 8, ["dt", "x"])
    (root / "dt=2024-01-03").mkdir()
    (root / "dt=2024-01-03" / "part-2").write_bytes(b"x")
    with pytest.raises(ValueError, match="different partition levels"):
        _listing_with_partitions(spark, str(root))
    (tmp_path / "none").mkdir()
    assert _listing_with_partitions(spark, str(tmp_path / "none")) == (0, 0, [])


def test_listing_is_one_call(spark, tmp_path, monkeypatch):
    """No call of the file system for each file."""
    from cdclake.plans import compact

    spark.range(0, 40, 1, 40).write.parquet(str(tmp_path / "t"))
    sent = spark._jvm._gateway_client.send_command
    calls = []
    monkeypatch.setattr(spark._jvm._gateway_client, "send_command", lambda *a, **b: calls.append(1) or sent(*a, **b))
    few = len(calls)
    assert compact._listing(spark, str(tmp_path / "t"))[0] == 40
    first = len(calls) - few
    spark.range(0, 80, 1, 80).write.parquet(str(tmp_path / "u"))
    few = len(calls)
    assert compact._listing(spark, str(tmp_path / "u"))[0] == 80
    assert abs(len(calls) - few - first) < 40


def test_orders_are_chosen_before_they_are_encoded(spark, tmp_path):
    rows = spark.createDataFrame([(k, k, "O", 1.0, None, "1") for k in (-3, -1, 0, 1, 2, None)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    ev = workloads.orders_events(spark, str(tmp_path))
    k = F.get_json_object("value", "$.payload.o_orderkey").cast("bigint") % 2
    for odd in (0, 1):
        chosen = workloads.orders_events(spark, str(tmp_path), where=F.col("o_orderkey") % 2 == odd)
        assert sorted(r["value"] for r in chosen.collect()) == sorted(r["value"] for r in ev.where(k == odd).collect())
