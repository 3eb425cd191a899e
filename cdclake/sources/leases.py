"""Leases of table paths: writes of one path are serialised between drivers (K3).

A path's grants are files ``_leases/<path>/<number>``; the next number is created
only if nobody created it before, so it has one holder and rises with each
grant: the fencing number. A holder marks its grant as alive from time to time, and as
done at the end. A grant that was not marked for longer than its holder promised is taken over; who
lost one so finds a higher number when it ends, and its write counts as failed.
All times are those that the file system gives to files, so drivers' clocks don't matter.
"""

from __future__ import annotations

import json
import os
import threading
import time
import uuid

from pyspark.sql import SparkSession

from .manifest import file_system, relative_to

LEASES_DIR = "_leases"


class LeaseLost(RuntimeError):
    """Another driver took the path over while this one wrote to it."""


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text``; False if it is there already.

    In a local folder the whole file appears at once, also to other processes; elsewhere the
    file system's create decides, and the text follows.
    """
    fs, p = file_system(spark, path)
    if fs.getUri().getScheme() == "file":
        target = fs.makeQualified(p).toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        draft = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
        with open(draft, "w") as out:
            out.write(text)
        try:
            os.link(draft, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - the JVM's error, by its name
        if "AlreadyExists" not in str(e):
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


class PathLease:
    """Hold the lease of a path while a block runs; ``number`` is its fencing number.

    ``seconds`` is how long a holder may be silent before others take over; it says that it is
    alive four times as often. Waiting ends with an error after ``wait_seconds``. Leaving the block raises :class:`LeaseLost` if the lease was taken over.
    """

    def __init__(self, spark: SparkSession, base_path: str, path: str, *, seconds: float = 60.0, wait_seconds: float = 3600.0) -> None:
        self.spark, self.seconds, self.wait_seconds = spark, float(seconds), wait_seconds
        self.folder = f"{base_path.rstrip('/')}/{LEASES_DIR}/{relative_to(path, base_path)}"
        self.number, self._stop, self._beats = 0, threading.Event(), None

    def _touch(self, name: str) -> int:
        """Write an empty file; returns the time that the file system gave it."""
        fs, p = file_system(self.spark, f"{self.folder}/{name}")
        fs.create(p, True).close()
        return int(fs.getFileStatus(p).getModificationTime())  # of a name that no other holder uses

    def _files(self) -> dict[str, int]:
        """Names in the lease's folder and their times."""
        fs, p = file_system(self.spark, self.folder)
        for attempt in range(20):
            try:
                return {s.getPath().getName(): int(s.getModificationTime()) for s in fs.listStatus(p)} if fs.exists(p) else {}
            except Exception as e:  # noqa: BLE001 - the JVM's error, by its name: a local folder's file went while it was listed
                if "FileNotFound" not in str(e) and "NoSuchFile" not in str(e) or attempt == 19:
                    raise

    @staticmethod
    def _newest(files: dict[str, int]) -> int:
        return max((int(x) for x in files if x.isdigit()), default=0)

    def _now(self) -> int:
        name = f".now-{uuid.uuid4().hex}"
        try:
            return self._touch(name)
        finally:
            self._delete(name)

    def _delete(self, name: str) -> None:
        fs, p = file_system(self.spark, f"{self.folder}/{name}")
        fs.delete(p, False)

    def _free(self, files: dict[str, int], newest: int) -> bool:
        if not newest or f"{newest:08d}.done" in files:
            return True
        seen = max(files.get(f"{newest:08d}.alive", 0), files[f"{newest:08d}"])
        return self._now() - seen > self._promised(newest) * 1000

    def _promised(self, number: int) -> float:
        """The silence that the holder of a grant asked to be allowed."""
        fs, p = file_system(self.spark, f"{self.folder}/{number:08d}")
        try:
            stream = fs.open(p)
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            return float(json.loads(text)["seconds"])
        except Exception:  # noqa: BLE001 - being written, or just cleaned up after a newer grant
            return self.seconds

    def held(self) -> bool:
        return self._newest(self._files()) == self.number

    def __enter__(self) -> "PathLease":
        end = time.monotonic() + self.wait_seconds
        while True:
            files = self._files()
            newest = self._newest(files)
            if self._free(files, newest) and create_new(self.spark, f"{self.folder}/{newest + 1:08d}", json.dumps({"seconds": self.seconds})):
                self.number = newest + 1
                if self.held():  # not if this number was granted, ended and cleaned up since the listing
                    break
                self._delete(f"{self.number:08d}")
            if time.monotonic() > end:
                raise TimeoutError(f"{self.folder} is held by grant {newest}")
            time.sleep(min(0.5, self.seconds / 4))
        for name in files:  # grants before the newest one say nothing any more
            if name[:8].isdigit() and int(name[:8]) < self.number:
                self._delete(name)
        self._stop.clear()
        self._beats = threading.Thread(target=self._beat, daemon=True)
        self._beats.start()
        return self

    def _beat(self) -> None:
        while not self._stop.wait(self.seconds / 4):
            try:
                if not self.held():
                    return
                self._touch(f"{self.number:08d}.alive")
            except Exception:  # noqa: BLE001 - tried again; if it goes on failing, the lease is lost, which its end notices
                continue

    def __exit__(self, kind: object, *rest: object) -> None:
        self._stop.set()
        self._beats.join()
        if self.held():
            self._touch(f"{self.number:08d}.done")
        elif kind is None:
            raise LeaseLost(f"{self.folder}: grant {self.number} was taken over while its holder wrote")


__all__ = ["LEASES_DIR", "LeaseLost", "PathLease", "create_new"]
