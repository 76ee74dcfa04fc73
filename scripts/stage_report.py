"""Per-step stage metrics from a Spark event log.

Usage: python scripts/stage_report.py <event log file or rolling-log folder> [label prefix]

Jobs are grouped by their description (``tidemark: <step>`` labels set by the
library); for each step it sums input bytes, shuffle bytes written, output
bytes and executor run time over the stages of its jobs.
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict

METRICS = {
    "internal.metrics.input.bytesRead": "input_mb",
    "internal.metrics.shuffle.write.bytesWritten": "shuffle_write_mb",
    "internal.metrics.output.bytesWritten": "output_mb",
    "internal.metrics.executorRunTime": "task_sec",
}


def _lines(path: str):
    """Event lines of a log file (plain or zstd) or of a rolling-log folder."""
    if os.path.isdir(path):
        files = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(f.split("_")[1]))
        for f in files:
            yield from _lines(os.path.join(path, f))
        return
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(path) as f:
        yield from f


def main() -> None:
    path = sys.argv[1]
    prefix = sys.argv[2] if len(sys.argv) > 2 else "tidemark: "
    stage_label: dict[int, str] = {}
    totals: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    jobs: dict[str, int] = defaultdict(int)
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            label = (ev.get("Properties") or {}).get("spark.job.description") or "(unlabeled)"
            jobs[label] += 1
            for sid in ev.get("Stage IDs", []):
                stage_label[sid] = label
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            label = stage_label.get(info["Stage ID"], "(unlabeled)")
            for acc in info.get("Accumulables", []):
                name = acc.get("Name")
                if name in METRICS:
                    totals[label][METRICS[name]] += float(acc.get("Value") or 0)
    print(f"{'step':46s} {'jobs':>4s} {'input MB':>9s} {'shuffle MB':>10s} "
          f"{'output MB':>9s} {'task s':>7s}")
    for label in sorted(totals, key=lambda k: -totals[k]["task_sec"]):
        if not label.startswith(prefix):
            continue
        t = totals[label]
        print(f"{label[len(prefix):][:46]:46s} {jobs[label]:4d} {t['input_mb'] / 2**20:9.2f} "
              f"{t['shuffle_write_mb'] / 2**20:10.2f} {t['output_mb'] / 2**20:9.2f} "
              f"{t['task_sec'] / 1000:7.2f}")


if __name__ == "__main__":
    main()
