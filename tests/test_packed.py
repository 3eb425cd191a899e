"""Events in packed files, read in batch and by both streaming sources of files."""

import json
import time

import pytest
from pyspark.sql import functions as F

from cdclake import CdcConfig, TriggerPolicy, read_event_stream, read_events, read_table, start_stream, workloads
from cdclake.sources import lines
from cdclake.sources.events import write_events
from helpers import events, flat, fld

F1 = [fld("id", "int64"), fld("name", "string")]


def rows_of(spark, table: str, n: int, parts: int):
    """Events of one table, in ``parts`` partitions."""
    return events(spark, [(table, json.dumps({"id": i}), flat(F1, {"id": i, "name": f"n{i}"})) for i in range(n)]).coalesce(1).repartition(parts)


def test_events_are_packed(spark, tmp_path, monkeypatch):
    """A large table's events take a small part of their text's bytes, in batch and in streams."""
    folder, src = str(tmp_path), str(tmp_path / "src")
    spark.range(900).select(F.col("id").alias("o_orderkey")).write.parquet(f"{folder}/orders.parquet")
    assert workloads.event_packing(spark, folder, "orders") is None
    monkeypatch.setattr(workloads, "PLAIN_ROWS", 800)
    assert workloads.event_packing(spark, folder, "orders") == "gzip"
    ev = workloads.encode_events(spark.read.parquet(f"{folder}/orders.parquet"), "a.b.orders", headers={"h": F.col("o_orderkey")})
    policy = workloads.write_stream_files(spark, folder, ev, src, 3, "orders")
    packed = list((tmp_path / "src").glob("part-*"))
    assert len(packed) == 3 and all(p.name.endswith(".json.gz") for p in packed)
    text = ev.select(F.sum(F.octet_length("value"))).first()[0]
    assert sum(p.stat().st_size for p in packed) < text / 10
    as_rows = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert as_rows(read_events(spark, src, headers=True)) == as_rows(ev)
    q = start_stream(read_event_stream(spark, src, policy=policy), CdcConfig(base_path=f"{folder}/lake"), f"{folder}/ckpt", policy=policy)
    q.awaitTermination()
    t = read_table(spark, f"{folder}/lake/a.b.orders")
    assert sorted(r["o_orderkey"] for r in t.collect()) == list(range(900))
    assert spark.read.parquet(f"{folder}/lake/_ingest_log").select("batch_id").distinct().count() == 3


def texts_between(reader, a, b):
    return [x for p in reader.partitions(a, b) for batch in reader.read(p) for x in batch.column("line").to_pylist()]


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("block, split", [(50, 70), (1 << 20, 1 << 20), (7, 5)])
def test_batches_end_inside_packed_files(tmp_path, monkeypatch, packed, block, split):
    """Batches of a set number of rows, whatever their files' sizes and blank lines, plain or packed, and after a restart."""
    import gzip

    monkeypatch.setattr(lines, "BLOCK", block)
    monkeypatch.setattr(lines, "SPLIT", split)
    (src := tmp_path / "src").mkdir()
    texts = [f"é{i}" + "x" * (i * 7 % 40) for i in range(60)]
    for k, (low, high, end) in enumerate([(0, 25, "\n"), (25, 25, ""), (25, 40, ""), (40, 60, "\n\n\n")]):
        data = ("\n\n" * (k == 2) + "\n".join(texts[low:high]) + end).encode()
        (src / f"f{k}.json{'.gz' * packed}").write_bytes(gzip.compress(data) if packed else data)
        time.sleep(0.02)
    options = {"path": str(src), "checkpointLocation": str(tmp_path / "ckpt"), "rows": "7", "wait_ms": str(10**9), "list_ms": "0"}
    reader = lines.EventLineReader(options)
    at, got = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        assert texts_between(lines.EventLineReader(options), at, end) == texts_between(reader, at, end)
        got.append(texts_between(reader, at, end))
        at = end
    assert got == [texts[k : k + 7] for k in range(0, 56, 7)]  # the last four wait
    reader.wait_ms = 0
    assert texts_between(reader, at, reader.latestOffset()) == texts[56:]


def test_streams_by_rows_read_packed_files(spark, tmp_path):
    """Each event once, in batches that end inside packed files."""
    src, lake, ckpt = (str(tmp_path / x) for x in ("src", "lake", "ckpt"))
    write_events(rows_of(spark, "t.a", 50, 1), src, files=3, compression="gzip")
    policy = TriggerPolicy("MaxBatchSizeWait", max_batch_size=20, max_wait_ms=500)
    results: list = []
    stream = read_event_stream(spark, src, policy=policy, checkpoint_location=ckpt)
    q = start_stream(stream, CdcConfig(base_path=lake), ckpt, policy=policy, on_batch=results.append)
    workloads.wait_for_rows(q, results, 50, 120)
    assert [r.rows for r in results if r.rows] == [20, 20, 10]
    assert sorted(r["id"] for r in read_table(spark, f"{lake}/t.a").collect()) == list(range(50))
