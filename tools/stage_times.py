"""Summarise a Spark event log: the slowest stages with their task counts and task time.

Usage: python tools/stage_times.py <event log file or folder> [top N]
(The bench writes one with BENCH_EVENT_LOG=<folder>; the Spark UI stays off.)
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path: str):
    """Lines of an event log file; Spark 4 compresses them with zstd by default."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def stages(path: str) -> list[dict]:
    files = [os.path.join(path, f) for f in sorted(os.listdir(path))] if os.path.isdir(path) else [path]
    out, task_ms = [], {}
    for f in files:
        if os.path.isdir(f):
            out += stages(f)
            continue
        name = os.path.basename(f)
        if not name.startswith(("events_", "local-", "app-", "application_")) or name.endswith(".crc"):
            continue  # status markers and checksums
        for line in _lines(f):
            if line.strip():
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    key = (ev["Stage ID"], ev["Stage Attempt ID"])
                    task_ms[key] = task_ms.get(key, 0) + info["Finish Time"] - info["Launch Time"]
                elif kind == "SparkListenerStageCompleted":
                    st = ev["Stage Info"]
                    out.append({"stage": st["Stage ID"], "attempt": st["Stage Attempt ID"], "name": st["Stage Name"],
                                "tasks": st["Number of Tasks"],
                                "wall_ms": st.get("Completion Time", 0) - st.get("Submission Time", 0)})
    for s in out:
        s.setdefault("task_ms", task_ms.get((s["stage"], s["attempt"]), 0))
    return out


def main() -> None:
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted(stages(sys.argv[1]), key=lambda s: -s["wall_ms"])
    print(f"{'wall ms':>8} {'task ms':>9} {'tasks':>6}  stage")
    for s in rows[:top]:
        print(f"{s['wall_ms']:>8} {s['task_ms']:>9} {s['tasks']:>6}  {s['stage']}.{s['attempt']} {s['name'][:90]}")
    print(f"stages: {len(rows)}, wall ms total: {sum(s['wall_ms'] for s in rows)}")


if __name__ == "__main__":
    main()
