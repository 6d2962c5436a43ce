"""Longest stages from a Spark event log folder (e.g. BENCH_EVENTLOG=... python bench.py).

Usage: python tools/stage_times.py EVENT_LOG_DIR [N]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(folder):
    for f in glob.glob(os.path.join(folder, "**", "*"), recursive=True):
        if not (os.path.isfile(f) and "events_" in os.path.basename(f)):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main():
    folder, n = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(folder):
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((dur, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:70]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.2f} stage-seconds")
    for dur, sid, tasks, name in stages[:n]:
        print(f"{dur:7.2f}s  stage {sid:5d}  tasks={tasks:5d}  {name}")


if __name__ == "__main__":
    main()
