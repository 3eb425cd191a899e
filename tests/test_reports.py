import pytest

from cdclake import (CdcConfig, batch_utilisation, compact_partition, ingest_batch, lag_report, progress_by_interval,
                     progress_report, read_table)
from helpers import events, flat, fld


def test_batch_utilisation_seeded_history_and_bands(spark):
    log = spark.createDataFrame([("a", i, n) for i, n in enumerate([100, 100, 100, 96, 0])],
                                "destination string, batch_id int, rows bigint")
    got = batch_utilisation(log, 100).orderBy("batch_id").collect()
    assert [round(r["avg3"], 4) for r in got] == [34.0, 67.0, 100.0, 98.6667, 65.3333]
    assert [r["band"] for r in got] == ["<85%", "<85%", ">=97%", ">=97%", "<85%"]
    assert [r["wait_factor"] for r in got] == ["grow", "grow", "0.50", "0.50", "grow"]


@pytest.mark.parametrize("avg,band", [(95.5, ">=95%"), (91, ">=90%"), (86, ">=85%")])
def test_bands(spark, avg, band):
    log = spark.createDataFrame([("a", 0, float(avg * 3 - 2))], "destination string, batch_id int, rows double")
    assert batch_utilisation(log, 100).first()["band"] == band


def test_lag_and_progress(spark):
    df = spark.createDataFrame([("a", 1000, "r"), ("a", 1500, "c"), ("b", 1900, "u")],
                               "destination string, __source_ts_ms bigint, __op string")
    got = {r["destination"]: r for r in lag_report(df, 2000).collect()}
    assert (got["a"]["rows"], got["a"]["max_lag_ms"], got["a"]["min_lag_ms"], got["a"]["snapshot_rows"]) == (2, 1000, 500, 1)
    log = spark.createDataFrame([("a", 0, 5, 0), ("a", 1, 7, 600_000), ("a", 2, 1, 1_000_000), ("b", 0, 2, 0)],
                                "destination string, batch_id long, rows long, batch_time_ms long")
    run = {(r["destination"], r["batch_id"]): r["running_total"] for r in progress_report(log).collect()}
    assert run == {("a", 0): 5, ("a", 1): 12, ("a", 2): 13, ("b", 0): 2}
    per = sorted((r["destination"], r["rows"]) for r in progress_by_interval(log).collect())
    assert per == [("a", 1), ("a", 12), ("b", 2)]


def test_compaction_keeps_rows_and_reduces_files(spark, lake):
    f = [fld("id", "int64"), fld("v", "string")]
    ev = events(spark, [("t", None, flat(f, {"id": i, "v": str(i)})) for i in range(200)]).repartition(8)
    res = ingest_batch(ev, CdcConfig(base_path=lake, rows_per_file=None), batch_id=0)
    src = res.groups[0].path
    out = compact_partition(spark, src, files=1)
    assert out.files_before == 8 and out.files_after == 1 and out.rows == 200
    a = read_table(spark, src).drop("input_file")
    b = read_table(spark, out.target_path).drop("input_file")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    with pytest.raises(Exception):
        compact_partition(spark, src, files=1, target_path=out.target_path)


def test_compaction_sizes_output_by_bytes(spark, lake):
    from cdclake.plans.compact import _listing

    f = [fld("id", "int64"), fld("v", "string")]
    ev = events(spark, [("t", None, flat(f, {"id": i, "v": "x" * 200})) for i in range(400)]).repartition(8)
    src = ingest_batch(ev, CdcConfig(base_path=lake, rows_per_file=None), batch_id=0).groups[0].path
    n_files, n_bytes = _listing(spark, src)
    assert n_files == 8
    out = compact_partition(spark, src, target_file_bytes=n_bytes // 3 + 1)
    assert out.files_after == 3 and out.rows == 400
    assert compact_partition(spark, src).files_after == 1  # default target: one file for a small partition


def test_compaction_of_a_partitioned_root_keeps_its_folders(spark, lake):
    f = [fld("id", "int64"), fld("v", "string")]
    cfg = CdcConfig(base_path=lake, partition=True, rows_per_file=None)
    for day in range(2):
        ev = events(spark, [("t", None, flat(f, {"id": day * 100 + i, "v": "x"})) for i in range(50)]).repartition(4)
        ingest_batch(ev, cfg, batch_id=day, batch_time_ms=1_700_000_000_000 + day * 86_400_000)
    out = compact_partition(spark, f"{lake}/t", files=1)
    assert out.files_before == 8 and out.rows == 100
    t = read_table(spark, out.target_path)
    assert sorted(r["dt"].isoformat() for r in t.select("dt").distinct().collect()) == ["2023-11-14", "2023-11-15"]
    assert t.filter("dt = '2023-11-15'").count() == 50 and "dt" not in spark.read.parquet(
        f"{out.target_path}/dt=2023-11-15").columns


def test_listing_skips_markers_and_finds_partition_levels(spark, tmp_path):
    from cdclake.plans.compact import _listing_with_partitions

    root = tmp_path / "t"
    (root / "dt=2024-01-01" / "batch_id=3").mkdir(parents=True)
    (root / "dt=2024-01-01" / "batch_id=3" / "part-0.parquet").write_bytes(b"x" * 10)
    (root / "dt=2024-01-01" / "batch_id=3" / ".part-0.parquet.crc").write_bytes(b"c")
    (root / "_SUCCESS").write_bytes(b"")
    (root / "_temporary" / "0").mkdir(parents=True)
    (root / "_temporary" / "0" / "part-9.parquet").write_bytes(b"y" * 99)
    assert _listing_with_partitions(spark, str(root)) == (1, 10, ["dt", "batch_id"])
