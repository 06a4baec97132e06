"""Stage and task times of the whole job, read from Spark's event log.

Runs the job on ``sf_dir`` with the event log written to a fresh scratch
folder, then summarises the log: jobs, stages, tasks, and the slowest stages
by wall time with their call sites. Usage:

    python scripts/stage_times.py [sf_dir] [top_n]
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.job import WIDE_JOB, run_job  # noqa: E402
from tessera.plans.wide import load_wide  # noqa: E402
from tessera.session import local_session  # noqa: E402


def event_lines(log_dir: str):
    """Lines of a (possibly rolling, possibly zstd-compressed) event log."""
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith(("events_", "local-", "app-"))]

    def order(path: str) -> int:
        m = re.search(r"events_(\d+)_", os.path.basename(path))
        return int(m.group(1)) if m else 0

    for path in sorted(files, key=order):
        if path.endswith(".zstd"):
            import zstandard

            with open(path, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(path) as fh:
                yield from fh


def summarise(log_dir: str, top: int) -> None:
    stages, jobs, tasks = [], 0, 0
    task_time = collections.Counter()
    for line in event_lines(log_dir):
        event = json.loads(line)
        kind = event.get("Event")
        if kind == "SparkListenerJobStart":
            jobs += 1
        elif kind == "SparkListenerTaskEnd":
            tasks += 1
            info = event["Task Info"]
            task_time[event["Stage ID"]] += info["Finish Time"] - info["Launch Time"]
        elif kind == "SparkListenerStageCompleted":
            info = event["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                stages.append((info["Completion Time"] - info["Submission Time"], info["Stage ID"],
                               info["Number of Tasks"], info["Stage Name"]))
    wall = sum(s[0] for s in stages)
    print(f"jobs {jobs}, stages {len(stages)}, tasks {tasks}, summed stage wall time {wall / 1000:.1f} s, "
          f"summed task time {sum(task_time.values()) / 1000:.1f} s")
    print(f"{'ms':>7} {'tasks':>5} {'task ms':>8}  stage")
    for ms, sid, ntasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:>7} {ntasks:>5} {task_time[sid]:>8}  {name[:90]}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    log_dir = tempfile.mkdtemp(prefix="tessera-eventlog-")
    spark = local_session(8, f"{log_dir}-checkpoint", app="tessera-stage-times", **{
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
    })
    result = run_job(spark, load_wide(spark, sf_dir), WIDE_JOB)
    print("stage timings (s):", json.dumps(result.timings))
    spark.stop()
    summarise(log_dir, top)


if __name__ == "__main__":
    main()
