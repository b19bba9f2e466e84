"""Summarise stage and job durations from a Spark event log folder (zstd or plain)."""

from __future__ import annotations

import glob
import io
import json
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(folder: str):
    stages, jobs = {}, {}
    for f in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"],
                                          si["Completion Time"] - si["Submission Time"], si["Submission Time"])
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
    t0 = min(v[3] for v in stages.values())
    for k, v in sorted(stages.items()):
        print(f"stage {k:4d} start+{v[3] - t0:6d}ms {v[2]:6d}ms tasks={v[1]:3d} {v[0]}")
    for k, v in sorted(jobs.items()):
        print(f"job {k:4d} start+{v[0] - t0:6d}ms {(v[1] or v[0]) - v[0]:6d}ms stages={v[2]}")


if __name__ == "__main__":
    main(sys.argv[1])
