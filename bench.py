"""Benchmark: the whole clustering job plus the heavier standalone queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

profile, trim_scale, sweep (k = 2..15, maxIter 50), final_fit (maxIter 200, tol 1e-6,
initSteps 10), silhouette, analysis, pca. Standalone queries are forced with
the no-op sink so the whole plan runs without collecting rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.plans.job import WIDE_JOB, run_job  # noqa: E402
from tessera.plans.wide import load_wide  # noqa: E402
from tessera.session import clear_scratch, local_session  # noqa: E402

REFERENCE_ROWS_PER_SEC = round(134_483 / 49.02, 1)

WRITES_ITS_INPUT = ("json_nested_scan", "csv_tab_scan")
STANDALONE = ("word_count", "summary_stats", "outlier_trim", "silhouette", *WRITES_ITS_INPUT)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="tessera-bench-")
    spark = local_session(cpus, folder, app="tessera-bench", **{"spark.driver.memory": "8g"})
    match = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(match.group(1)) if match else None

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    result = run_job(spark, load_wide(spark, sf_dir), WIDE_JOB)
    _run(result.pca)
    job_total = time.perf_counter() - t0
    times.update({f"job_{k}": v for k, v in result.timings.items()})
    times["job_total"] = round(job_total, 3)

    result.release()
    for key in STANDALONE:
        t = time.perf_counter()
        df = catalog.QUERIES[key](spark, sf_dir)
        if key in WRITES_ITS_INPUT:
            # the text files are written when the query is built; the read is timed apart
            times[f"{key}_write"] = round(time.perf_counter() - t, 3)
            t = time.perf_counter()
        _run(df)
        times[key] = round(time.perf_counter() - t, 3)
    clear_scratch(spark)

    print(
        json.dumps(
            {
                "metric": "cluster_job_total",
                "value": round(job_total, 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "rows": result.counts,
                "prepared_rows_per_sec": round(result.counts["rows_prepared"] / job_total, 1),
                "reference_rows_per_sec": REFERENCE_ROWS_PER_SEC,
                "k": result.k,
                "silhouette": round(result.silhouette, 6),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
