"""Leases of table paths between drivers, and files that only one of several writers creates."""

import os
import subprocess
import sys
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

import cdclake.plans.ingest as ingest
from cdclake import CdcConfig, ingest_batch, read_table
from cdclake.sources.leases import LEASES_DIR, LeaseLost, PathLease, create_new
from helpers import events, flat, fld

F1 = [fld("id", "int64"), fld("name", "string")]


def test_two_drivers_on_one_path_lose_and_double_nothing(spark, tmp_path):
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "lease_job.py")
    lake, batches = str(tmp_path / "lake"), 8
    runs = [subprocess.Popen([sys.executable, job, lake, str(k), str(batches), str(tmp_path / "start")], stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True) for k in (0, 1)]
    for run in runs:
        _, err = run.communicate(timeout=600)
        assert run.returncode == 0, err[-3000:]
    assert sorted(r["id"] for r in read_table(spark, f"{lake}/t").select("id").collect()) == list(range(2 * batches * 100))
    assert spark.read.parquet(f"{lake}/_ingest_log").groupBy().sum("rows").first()[0] == 2 * batches * 100  # the log is such a path, too
    grants = [x for x in os.listdir(f"{lake}/{LEASES_DIR}/t") if x.isdigit()]
    assert max(int(x) for x in grants) == 2 * batches  # each write had a number of its own
    assert len(grants) <= 2


def test_one_holder_at_a_time_and_numbers_rise(spark, lake):
    inside, most, numbers, guard = [0], [0], [], threading.Lock()

    def work(_):
        for _ in range(5):
            with PathLease(spark, lake, f"{lake}/t", seconds=30) as lease:
                with guard:
                    inside[0] += 1
                    most[0] = max(most[0], inside[0])
                    numbers.append(lease.number)
                time.sleep(0.01)
                with guard:
                    inside[0] -= 1

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(4)))
    assert most[0] == 1 and numbers == sorted(set(numbers)) and len(numbers) == 20


def test_a_silent_holder_is_replaced_and_learns_it(spark, lake, monkeypatch):
    monkeypatch.setattr(PathLease, "_beat", lambda self: None)
    with pytest.raises(LeaseLost):
        with PathLease(spark, lake, f"{lake}/t", seconds=0.5) as old:
            with PathLease(spark, lake, f"{lake}/t", seconds=0.5, wait_seconds=30) as new:  # after half a second
                assert new.number == old.number + 1 and not old.held()


def test_a_holder_that_shows_life_keeps_its_lease(spark, lake):
    with PathLease(spark, lake, f"{lake}/t", seconds=1) as old:
        with pytest.raises(TimeoutError):
            PathLease(spark, lake, f"{lake}/t", seconds=0.1, wait_seconds=3).__enter__()  # the holder's second counts, not the contender's
        assert old.held()
        with PathLease(spark, lake, f"{lake}/other", wait_seconds=1) as other:
            assert other.number == 1
    with PathLease(spark, lake, f"{lake}/t", wait_seconds=1) as next_one:
        assert next_one.number == old.number + 1


def test_a_batch_that_lost_its_lease_is_not_published(spark, lake, monkeypatch):
    cfg = CdcConfig(base_path=lake, manifest=True, stream_id="s", lease_seconds=30)
    ev = events(spark, [("t", None, flat(F1, {"id": i, "name": "n"})) for i in range(5)])
    enter = PathLease.__enter__

    def overtaken(self):
        enter(self)
        create_new(spark, f"{self.folder}/{self.number + 1:08d}", "{}")  # another driver's grant
        create_new(spark, f"{self.folder}/{self.number + 1:08d}.done", "")
        return self

    monkeypatch.setattr(PathLease, "__enter__", overtaken)
    with pytest.raises(LeaseLost):
        ingest_batch(ev, cfg, batch_id=0, batch_time_ms=1)
    monkeypatch.setattr(PathLease, "__enter__", enter)
    assert ingest.read_manifest(spark, lake).count() == 0
    ingest_batch(ev, cfg, batch_id=0, batch_time_ms=1)
    assert sorted(r["id"] for r in read_table(spark, f"{lake}/t", manifest=lake).select("id").collect()) == list(range(5))


def test_a_file_is_created_once_with_all_its_text(spark, lake):
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: create_new(spark, f"{lake}/x/0001", f"text {k}"), range(16)))
    assert sum(made) == 1
    assert open(f"{lake}/x/0001").read() == f"text {made.index(True)}"
    assert os.listdir(f"{lake}/x") == ["0001"]
