"""Batches published by a file manifest, reads planned from it, shared writes and compaction by file lists."""

import os

import pytest

import cdclake.plans.ingest as ingest
from cdclake import CdcConfig, ingest_batch, read_table
from cdclake.plans.compact import bins_of, compact_published
from cdclake.sources.manifest import active_files, delete_removed, read_manifest
from helpers import events, flat, fld

F1 = [fld("id", "int64"), fld("name", "string")]
F2 = F1 + [fld("extra", "string")]


def batch(spark, dests, lo, hi, fields=F1, **row):
    return events(spark, [(d, None, flat(fields, {"id": i, "name": f"n{i}"} | row)) for d in dests for i in range(lo, hi)])


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def parts(lake, table):
    return [os.path.join(d, f) for d, _, fs in os.walk(f"{lake}/{table}") for f in fs if f.endswith(".parquet")]


def test_a_failed_batch_shows_nothing_and_its_replay_all(spark, lake, monkeypatch):
    cfg = CdcConfig(base_path=lake, manifest=True, stream_id="s", parallel_writes=1)
    ingest_batch(batch(spark, ["a", "b", "c"], 0, 5), cfg, batch_id=0)
    write, calls = ingest.write_group, []

    def fail_third(*args, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost before the third table")
        return write(*args, **kw)

    monkeypatch.setattr(ingest, "write_group", fail_third)
    second = batch(spark, ["a", "b", "c"], 5, 9)
    with pytest.raises(RuntimeError):
        ingest_batch(second, cfg, batch_id=1)
    assert sum(len(ids(read_table(spark, f"{lake}/{d}"))) for d in "ab") == 18  # files of two tables are there, unpublished
    for d in "abc":
        assert ids(read_table(spark, f"{lake}/{d}", manifest=lake)) == list(range(5))
    monkeypatch.undo()
    for _ in range(2):  # the replay lands it, a replay of a published batch does nothing
        assert ingest_batch(second, cfg, batch_id=1).rows == 12
        for d in "abc":
            assert ids(read_table(spark, f"{lake}/{d}", manifest=lake)) == list(range(9))
    with pytest.raises(ValueError):
        ingest_batch(second, CdcConfig(base_path=lake, manifest=True), batch_id=1)


def test_manifest_rows_describe_the_files(spark, lake):
    cfg = CdcConfig(base_path=lake, manifest=True, partition=True, rows_per_file=10)
    ingest_batch(batch(spark, ["a"], 0, 25), cfg, batch_time_ms=1_700_000_000_000)
    rows = active_files(spark, lake, f"{lake}/a").collect()
    assert sum(r.rows for r in rows) == 25 and max(r.rows for r in rows) <= 10
    assert {r.file for r in rows} == {os.path.relpath(p, f"{lake}/a") for p in parts(lake, "a")}
    assert all(r.bytes == os.path.getsize(f"{lake}/a/{r.file}") and r.min_ts_ms == r.max_ts_ms == 1_600_000_000_123 for r in rows)
    out = read_table(spark, f"{lake}/a", manifest=lake)
    assert ids(out) == list(range(25)) and {"dt", "input_file"} <= set(out.columns)
    assert out.where("dt = '2023-11-14'").count() == 25


def test_reads_open_only_uncovered_files_while_planning(spark, lake):
    cfg = CdcConfig(base_path=lake, manifest=True)
    ingest_batch(batch(spark, ["a"], 0, 5), cfg)
    covered = parts(lake, "a")
    ingest_batch(batch(spark, ["a"], 5, 8, F2, extra="x"), CdcConfig(base_path=lake, ingest_log=False))  # the manifest lacks it
    bodies = {}
    for p in covered:
        with open(p, "rb") as f:
            bodies[p] = f.read()
        with open(p, "wb") as f:
            f.write(b"no footer" + b"\0" * (len(bodies[p]) - 9))
    planned = read_table(spark, f"{lake}/a", manifest=lake, uncovered="read")  # would fail if a covered file were opened
    assert "extra" in planned.columns
    for p, body in bodies.items():
        with open(p, "wb") as f:
            f.write(body)
        crc = os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc")
        assert os.path.exists(crc)
    assert ids(read_table(spark, f"{lake}/a", manifest=lake, uncovered="read")) == list(range(8))
    hidden = read_table(spark, f"{lake}/a", manifest=lake)
    assert ids(hidden) == list(range(5)) and "extra" not in hidden.columns


def test_deleted_files_are_left_out(spark, lake):
    cfg = CdcConfig(base_path=lake, manifest=True)
    ingest_batch(batch(spark, ["a"], 0, 5), cfg)
    first = parts(lake, "a")
    ingest_batch(batch(spark, ["a"], 5, 8), cfg)
    for p in first:
        os.remove(p)
    assert ids(read_table(spark, f"{lake}/a", manifest=lake)) == [5, 6, 7]
    assert read_table(spark, f"{lake}/missing", manifest=lake).count() == 0


def test_shared_writes_land_many_destinations_by_one_job(spark, lake, monkeypatch):
    writes = []
    shared = ingest.write_shared
    monkeypatch.setattr(ingest, "write_shared", lambda *a, **kw: writes.append(1) or shared(*a, **kw))
    monkeypatch.setattr(ingest, "write_group", None)
    dests = [f"srv.db/x.t{i}" for i in range(200)]
    rows = [(d, None, flat(F1, {"id": i * 1000 + k, "name": d})) for i, d in enumerate(dests) for k in range(i % 7 + 1)]
    spark.sparkContext.setJobGroup("shared", "one write")
    cfg = CdcConfig(base_path=lake, shared_writes=True, partition=True, prefix="raw_", dest_regexp=r"^srv\.", dest_replace="")
    res = ingest_batch(events(spark, rows), cfg, batch_time_ms=1_700_000_000_000)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("shared"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert writes == [1] and jobs < 20 and res.rows == len(rows) and len(res.groups) == 200
    by_path = {g.destination: g for g in res.groups}
    for i in (0, 6, 117):
        g = by_path[dests[i]]
        assert g.rows == i % 7 + 1 and g.path.endswith("/dt=2023-11-14") and "raw_db%2Fx.t" in g.path
        t = read_table(spark, g.path.rpartition("/")[0], ingest_log=f"{lake}/_ingest_log")
        assert ids(t) == [i * 1000 + k for k in range(i % 7 + 1)] and "dt" in t.columns
    whole = spark.read.parquet(lake)
    assert whole.count() == len(rows)


def test_shared_writes_with_schemas_quarantine_and_manifest(spark, lake):
    good = [(d, None, flat(F1, {"id": i, "name": "x"})) for d in ("a", "b") for i in range(4)]
    other = [("c", None, flat(F2, {"id": 1, "name": "y", "extra": "z"})), ("a", None, flat(F2, {"id": 9, "name": "y", "extra": "z"}))]
    bad = [("b", None, flat(F1, {"id": "no number", "name": "x"})), ("b", None, "{"), ("d", None, '{"id": 5}')]
    cfg = CdcConfig(base_path=lake, shared_writes=True, on_malformed="quarantine", manifest=True)
    res = ingest_batch(events(spark, good + other + bad), cfg)
    table = lambda d: read_table(spark, f"{lake}/destination={d}", manifest=lake)
    assert ids(table("a")) == [0, 1, 2, 3, 9] and ids(table("b")) == [0, 1, 2, 3] and ids(table("c")) == [1] and ids(table("d")) == [5]
    assert sum(g.rows for g in res.groups if g.kind == ingest.KIND_MALFORMED) == 2
    assert "extra" in table("a").columns and "extra" not in table("b").columns
    with pytest.raises(ValueError):
        ingest_batch(events(spark, [("a", None, flat([fld("destination", "string")], {"destination": "x"}))]), cfg)


def test_bins_hold_at_most_the_target():
    assert bins_of({"a": 5, "b": 5, "c": 4, "d": 9, "e": 1}, 10) == [["d", "e"], ["a", "b"]]
    assert bins_of({"a": 9}, 10) == [] and bins_of({}, 10) == []


def test_compaction_rewrites_small_files_only(spark, lake):
    cfg = CdcConfig(base_path=lake, manifest=True, partition=True, rows_per_file=None)
    day = 86_400_000
    large = batch(spark, ["a"], 1000, 21000).coalesce(1)
    ingest_batch(large, cfg.with_(rebalance="never"), batch_time_ms=1_700_000_000_000)
    for k in range(6):
        ingest_batch(batch(spark, ["a"], 10 * k, 10 * k + 5).coalesce(1), cfg.with_(rebalance="never"), batch_time_ms=1_700_000_000_000 + k // 3 * day)
    ingest_batch(batch(spark, ["a"], 100, 103, F2, extra="new").coalesce(1), cfg.with_(rebalance="never"), batch_time_ms=1_700_000_000_000)
    before = read_table(spark, f"{lake}/a", manifest=lake, provenance=False)
    rows = sorted(map(tuple, before.collect()), key=str)
    sizes = {r.file: r.bytes for r in active_files(spark, lake, f"{lake}/a").collect()}
    biggest = max(sizes, key=sizes.get)
    plan = compact_published(spark, lake, f"{lake}/a", target_file_bytes=sizes[biggest])
    assert (plan.removed, plan.added, plan.untouched, plan.rows) == (7, 2, 1, 33)
    after = {r.file: r.bytes for r in active_files(spark, lake, f"{lake}/a").collect()}
    assert len(after) == 3 and after[biggest] == sizes[biggest]
    assert sorted(map(tuple, before.collect()), key=str) == rows  # a reader from before goes on
    now = read_table(spark, f"{lake}/a", manifest=lake, provenance=False)
    assert sorted(map(tuple, now.select(before.columns).collect()), key=str) == rows
    assert delete_removed(spark, lake, f"{lake}/a") == 7
    assert sorted(map(tuple, read_table(spark, f"{lake}/a", manifest=lake, provenance=False).select(before.columns).collect()), key=str) == rows
    assert read_table(spark, f"{lake}/a", provenance=False).count() == len(rows)
    assert compact_published(spark, lake, f"{lake}/a", target_file_bytes=100).removed == 0
    assert read_manifest(spark, lake).where("removed").count() == 7


def test_versions_with_other_types_are_scans_of_their_own(spark, lake):
    cfg = CdcConfig(base_path=lake, manifest=True, partition=True)
    typed = lambda t, v: events(spark, [("a", None, flat([fld("id", "int64"), fld("v", t)], {"id": i, "v": v})) for i in range(3)])
    for t, v in (("int32", 1), ("int64", 2**40), ("float64", 0.5), ("int32", 2)):
        ingest_batch(typed(t, v), cfg, batch_time_ms=1_700_000_000_000)
    t = read_table(spark, f"{lake}/a", manifest=lake)
    assert dict(t.dtypes)["v"] == "double" and {"dt", "input_file"} <= set(t.columns)
    assert sorted(r.v for r in t.collect()) == [0.5] * 3 + [1.0] * 3 + [2.0] * 3 + [float(2**40)] * 3
