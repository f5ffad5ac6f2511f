"""Summarize a Spark event log: slowest stages with task count, duration and
shuffle bytes (offline; no UI or server).

    BENCH_EVENT_LOG=$(mktemp -d) python bench.py
    python tools/stage_times.py <event-log dir or file> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(fp: str):
    if fp.endswith(".zstd"):
        import zstandard

        with open(fp, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), errors="replace")
    else:
        with open(fp, errors="replace") as f:
            yield from f


def stages(path: str):
    if os.path.isdir(path):
        files = sorted(os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.startswith("events_") or f.startswith("local-"))
    else:
        files = [path]
    for fp in files:
        for line in _lines(fp):
            if line.strip():
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                yield {
                    "stage": info["Stage ID"],
                    "name": info.get("Stage Name", "")[:60],
                    "tasks": info.get("Number of Tasks"),
                    "ms": (end - start) if start and end else None,
                    "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten"),
                    "input": acc.get("internal.metrics.input.bytesRead"),
                }


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted((s for s in stages(path) if s["ms"] is not None), key=lambda s: -s["ms"])
    total = sum(s["ms"] for s in rows)
    print(f"{len(rows)} stages, {total / 1000:.1f} s summed stage time")
    for s in rows[:top]:
        print(f"stage {s['stage']:>5} {s['ms']:>7} ms tasks {s['tasks']:>4} input {s['input'] or 0:>10} shuffle_w {s['shuffle_write'] or 0:>10}  {s['name']}")


if __name__ == "__main__":
    main()
