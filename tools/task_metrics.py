"""Per-query task metrics (spill, shuffle bytes, task time) from Spark's event log.

Usage: python tools/task_metrics.py <sf_dir> <scratch_dir>
Each headline query runs under its own job group; the event log is written
to <scratch_dir> and summed per group. Prints a markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from hourgrid.plans.catalog import QUERIES  # noqa: E402
from hourgrid.session import get_session  # noqa: E402


def _lines(path: str):
    """Lines of an event-log file, plain or zstd-compressed (Spark 4 default)."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    sf, scratch = sys.argv[1], sys.argv[2]
    if "--parse-only" not in sys.argv:
        spark = get_session("local[8]", "hourgrid-task-metrics", {
            "spark.sql.shuffle.partitions": "16", "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch})
        sc = spark.sparkContext
        for name in HEADLINE:
            sc.setJobGroup(name, name)
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()
        spark.stop()
    stage_group: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = {}
    files = sorted(glob.glob(os.path.join(scratch, "**", "events_*"), recursive=True))
    for path in files:
        if path.endswith(".crc"):
            continue
        if True:
            for line in _lines(path):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group or not m:
                        continue
                    t = totals.setdefault(group, {"tasks": 0, "run_ms": 0, "mem_spill": 0, "disk_spill": 0,
                                                  "shuffle_write": 0, "shuffle_read": 0})
                    t["tasks"] += 1
                    t["run_ms"] += m.get("Executor Run Time", 0)
                    t["mem_spill"] += m.get("Memory Bytes Spilled", 0)
                    t["disk_spill"] += m.get("Disk Bytes Spilled", 0)
                    t["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    rd = m.get("Shuffle Read Metrics") or {}
                    t["shuffle_read"] += rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0)
    print("| query | tasks | task time s | shuffle written MB | spill (memory / disk) MB |")
    print("| --- | --- | --- | --- | --- |")
    for name in HEADLINE:
        t = totals.get(name)
        if t:
            print(f"| {name} | {t['tasks']} | {t['run_ms'] / 1000:.1f} | {t['shuffle_write'] / 1e6:.1f} "
                  f"| {t['mem_spill'] / 1e6:.1f} / {t['disk_spill'] / 1e6:.1f} |")


if __name__ == "__main__":
    main()
