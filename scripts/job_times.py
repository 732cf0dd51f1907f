"""Longest Spark jobs from an event log written by bench.py.

usage: BENCH_EVENT_LOG_DIR=/tmp/x/ev BENCH_ONLY=... python bench.py
       python scripts/job_times.py /tmp/x/ev [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(root: str):
    for f in glob.glob(os.path.join(root, "**", "*"), recursive=True):
        if not os.path.isfile(f) or "appstatus" in f:
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main() -> None:
    root, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    jobs: dict[int, list] = {}
    for e in events(root):
        if e.get("Event") == "SparkListenerJobStart":
            p = e.get("Properties", {})
            jobs[e["Job ID"]] = [e["Submission Time"], None, (p.get("callSite.short") or "").strip()]
        elif e.get("Event") == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
    done = sorted(((v[1] - v[0], k, v[2]) for k, v in jobs.items() if v[1]), reverse=True)
    print(f"{len(done)} jobs, {sum(d for d, _, _ in done)} ms in jobs")
    for d, k, site in done[:top]:
        print(f"{d:7d} ms  job {k:4d}  {site}")


if __name__ == "__main__":
    main()
