import json
import os
import subprocess
import sys

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(doc)
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and doc["value"] > 0
    assert doc["queries"]["job_total"] == doc["value"]
