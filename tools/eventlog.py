"""Summarise a Spark event log folder (jobs, stages, slowest stages).

usage: python tools/eventlog.py <event-log dir or app folder>
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(root: str) -> None:
    files = []
    for dirpath, _d, names in os.walk(root):
        files += [os.path.join(dirpath, n) for n in names if n.startswith("events") or n.startswith("local-")]
    jobs, stages = 0, {}
    for f in sorted(files):
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                jobs += 1
            elif e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"], si["Number of Tasks"],
                                          si["Stage Name"][:80])
    total = sum(v[0] for v in stages.values())
    print(f"jobs {jobs} stages {len(stages)} stage-ms {total} mean {total // max(1, len(stages))}")
    for ms, n, name in sorted(stages.values(), reverse=True)[:10]:
        print(f"{ms:7d} ms {n:5d} tasks  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
