"""What a large batch takes of the disk while it is landed."""

import json
from collections import Counter

import pytest

from cdclake import CdcConfig, ingest_batch, read_table
from cdclake.plans import ingest
from cdclake.plans.ingest import holds_few_tables, keyed_events, stage_batch, write_group
from helpers import events, flat, fld

F1 = [fld("id", "int64"), fld("name", "string")]


def rows_of(spark, table: str, n: int, parts: int):
    """Events of one table, in ``parts`` partitions."""
    return events(spark, [(table, json.dumps({"id": i}), flat(F1, {"id": i, "name": f"n{i}"})) for i in range(n)]).coalesce(1).repartition(parts)


def test_batches_hold_keys_only_for_bad_events(spark):
    """F1 F2: nothing reads an event's key unless bad events are kept."""
    ev = rows_of(spark, "t.a", 3, 1)
    assert "key" not in keyed_events(ev, CdcConfig(base_path="")).columns
    assert "key" in keyed_events(ev, CdcConfig(base_path="", on_malformed="quarantine")).columns


@pytest.mark.parametrize("storage", ["cache", "table"])
def test_bad_events_keep_their_keys(spark, lake, storage):
    bad = flat(F1, {"id": "none", "name": "x"})
    ev = events(spark, [("t.a", "k1", flat(F1, {"id": 1, "name": "x"})), ("t.a", "k2", bad), ("t.a", "k3", "{")])
    ingest_batch(ev, CdcConfig(base_path=lake, on_malformed="quarantine", batch_storage=storage), batch_time_ms=0)
    assert sorted((r["key"], r["value"]) for r in spark.read.json(f"{lake}/_quarantine/t.a").collect()) == [("k2", bad), ("k3", "{")]
    assert [r["id"] for r in read_table(spark, f"{lake}/t.a").collect()] == [1]


def test_partitions_of_few_tables_are_told(spark):
    """Partitions of one table each, however many tables and how small the first; not mixed ones, and no frame whose shuffle would run again."""
    single = [rows_of(spark, f"t.{k}", 3, 2) for k in range(8)]
    union = single[0]
    for ev in single[1:]:
        union = union.union(ev)
    assert holds_few_tables(union) and holds_few_tables(rows_of(spark, "t.a", 50, 3))
    mixed = events(spark, [(f"t.{i % 8}", None, "{}") for i in range(64)])
    assert not holds_few_tables(mixed) and not holds_few_tables(union.repartition("key"))


def test_tables_are_staged_without_a_shuffle(spark, lake, monkeypatch):
    """A batch whose partitions hold one table each is written as it is."""
    took = []
    monkeypatch.setattr(ingest, "stage_batch", lambda keyed, few_tables=False: took.append(few_tables) or stage_batch(keyed, few_tables))
    union = rows_of(spark, "t.a", 30, 4).union(rows_of(spark, "t.b", 20, 3))
    ingest_batch(union, CdcConfig(base_path=lake, batch_storage="table", min_partitions=2), batch_time_ms=0)
    assert took == [True]
    for t, n in (("a", 30), ("b", 20)):
        assert sorted(r["id"] for r in read_table(spark, f"{lake}/t.{t}").collect()) == list(range(n))
    staged, path = stage_batch(keyed_events(union, CdcConfig(base_path="")), True)
    files = [x.rsplit("/", 2)[-2] for x in staged.inputFiles()]
    assert sorted(Counter(files).values()) == [3, 4] and all(x.endswith(".zstd.parquet") for x in staged.inputFiles())
    ingest._delete(spark, path)


@pytest.mark.parametrize("size, shuffled", [(10, True), (1000, False)])
def test_rows_of_large_groups_are_not_dealt_for_full_files(spark, lake, monkeypatch, size, shuffled):
    """A few more files than tasks; there are never more than twice as many."""
    monkeypatch.setattr(ingest, "DEAL_BYTES", 100)
    n = write_group(spark.range(0, 600, 1, 4), f"{lake}/t", CdcConfig(base_path=lake, rows_per_file=100), 600, size=size)
    t = read_table(spark, f"{lake}/t")
    assert n == t.count() == t.select("id").distinct().count() == 600
    assert t.select("input_file").distinct().count() == (6 if shuffled else 8)


@pytest.mark.parametrize("scanned, files", [(100, 2), (400, 4), (4000, 2)])
def test_small_parts_of_a_cached_batch(spark, lake, monkeypatch, scanned, files):
    """F1 F2: a few tasks more than files read the cache, rather than a shuffle; one that needs many more is dealt."""
    monkeypatch.setattr(ingest, "TASK_BYTES", 50)
    write_group(spark.range(0, 200, 1, 16), f"{lake}/t", CdcConfig(base_path=lake, rows_per_file=100), 200, size=10, scanned=scanned)
    t = read_table(spark, f"{lake}/t")
    assert t.count() == 200 and t.select("input_file").distinct().count() in (files, files + 1)  # dealt rows begin anywhere
