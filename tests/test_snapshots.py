"""Snapshots by their reads, progress rows of streams, and schemas of tables without one."""

import json
import threading
import time

import pytest

from cdclake import CdcConfig, ProgressLog, TriggerPolicy, ingest_batch, read_event_stream, read_table, start_stream
from cdclake.operators.reports import snapshot_state
from cdclake.sources.events import write_events
from cdclake.sources.schemas import join_schema, stored_schema
from cdclake.streaming.progress import backlog_of, progress_row
from helpers import events, flat, fld


def test_snapshots_are_runs_of_reads(spark):
    rows = []

    def add(dest, batch, ops):
        rows.extend((dest, batch, 100 * batch + i, op) for i, op in enumerate(ops))

    add("a", 0, "rrr")
    add("a", 1, "rrc")  # ends within the batch
    add("a", 2, "uu")
    add("a", 4, "rr")  # runs
    add("b", 0, "cc")
    add("c", 0, "r")
    add("c", 1, "cr")  # the read is the last: one snapshot that runs on
    add("c", 2, "r")
    add("c", 3, "d")  # ended by the next batch
    rows.append(("d", 0, None, "r"))
    got = snapshot_state(spark.createDataFrame(rows, "destination string, batch_id long, __lsn long, __op string")).collect()
    assert sorted(map(tuple, got)) == [("a", 1, 0, 1, 5, "completed"), ("a", 2, 4, 4, 2, "running"), ("c", 1, 0, 2, 3, "completed"), ("d", 1, 0, 0, 1, "running")]


def test_backlog_of_sources():
    assert backlog_of({"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 9, "1": 7}}}) == 4
    assert backlog_of({"endOffset": {"logOffset": 1}, "latestOffset": None}) is None and backlog_of({"endOffset": 3, "latestOffset": 2}) == 0
    assert backlog_of({"metrics": {"numFilesOutstanding": "6"}}) == 6
    row = progress_row({"id": "q", "batchId": 3, "timestamp": "t", "numInputRows": 5, "durationMs": {"triggerExecution": 9}, "sources": [{"endOffset": 1, "latestOffset": 4}]})
    assert row == ("q", 3, "t", 5, 0.0, 9, 3)


def test_listener_writes_a_row_for_each_batch(spark, tmp_path):
    src, lake = str(tmp_path / "src"), str(tmp_path / "lake")
    write_events(events(spark, [("a", None, flat([fld("id", "int64")], {"id": i})) for i in range(30)]), src, files=3)
    listener = ProgressLog(spark, lake)
    spark.streams.addListener(listener)
    try:
        policy = TriggerPolicy(max_files_per_trigger=1, available_now=True)
        q = start_stream(read_event_stream(spark, src, policy=policy), CdcConfig(base_path=lake), str(tmp_path / "ckpt"), policy=policy)
        q.awaitTermination()
        end, got = time.time() + 30, []
        while len(got) < 3 and time.time() < end:
            time.sleep(0.5)
            try:
                got = spark.read.parquet(f"{lake}/_progress").collect()
            except Exception:  # noqa: BLE001 - not there yet
                pass
    finally:
        spark.streams.removeListener(listener)
    assert sorted(r.batch_id for r in got) == [0, 1, 2] and sum(r.rows for r in got) == 30 and {r.query_id for r in got} == {q.id}


def plain(spark, rows):
    return events(spark, [("t", None, json.dumps(r)) for r in rows])


def test_schemaless_batches_meet_in_a_stored_schema(spark, lake):
    cfg = CdcConfig(base_path=lake, schema_store=True, ingest_log=False)
    ingest_batch(plain(spark, [{"a": 1, "s": {"x": 1}}]), cfg)
    ingest_batch(plain(spark, [{"a": 2.5, "b": "new", "s": {"y": "z"}}]), cfg)
    ingest_batch(plain(spark, [{"a": 7, "b": None}]), cfg)  # narrower: the stored type holds
    t = read_table(spark, f"{lake}/t", schema_store=lake)
    assert sorted((r.a, r.b, r.s and r.s.x, r.s and r.s.y) for r in t.collect()) == [(1.0, None, 1, None), (2.5, "new", None, "z"), (7.0, None, None, None)]
    assert dict(t.dtypes)["a"] == "double" and stored_schema(spark, lake, "t")[0] == 2
    with pytest.raises(ValueError):
        ingest_batch(plain(spark, [{"a": "text"}]), cfg)
    with pytest.raises(ValueError):
        read_table(spark, f"{lake}/none", schema_store=lake)


def test_concurrent_writers_join_their_schemas(spark, lake):
    structs = [spark.createDataFrame([], f"c{i} int, shared {t}").schema for i, t in enumerate(["int", "bigint", "double", "float"] * 3)]
    threads = [threading.Thread(target=join_schema, args=(spark, lake, "t", s)) for s in structs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    number, joined = stored_schema(spark, lake, "t", "payload")
    assert set(joined.fieldNames()) == {f"c{i}" for i in range(12)} | {"shared"} and joined["shared"].dataType.simpleString() == "double" and number <= 12
