"""Command-line job: raw catalogue → clean table → clusters → reports.

    python -m tessera --source products.json.gz --work-dir /shared/tessera-run \
        [--format json] [--rebuild] [--first-lines N | --max-rows N]

On a cluster ship the package and run this file, e.g.
``spark-submit --py-files tessera.zip tessera/cli.py --source ... --work-dir ...``
with ``--work-dir`` on shared storage; scratch tables lie below it unless
``spark.checkpoint.dir`` names a folder. Writes under ``--work-dir``:
``clean.parquet`` (reused when complete and of the same parameters), ``model/``,
``summary.json``, ``preview.json``, ``report.json``, ``sweep.json``,
``predictions.parquet``, ``pca_points.parquet``; prints the chosen k, the
silhouette and the rows of each stage, malformed ones included. ``journal/`` records what is
done, so the same command goes on where an ended run stopped. Sources are read whole unless
``--first-lines`` (JSON lines) or ``--max-rows`` names a part.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import SparkSession

from tessera.config import JobConfig
from tessera.plans.job import part_of, run_job
from tessera.session import use_checkpoint_dir
from tessera.sources import readers, sinks


def parse(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__.splitlines()[0])
    p.add_argument("--source", required=True, help="raw catalogue: JSON lines, delimited text or Parquet")
    p.add_argument("--work-dir", required=True, help="shared folder for the clean table, model and reports")
    p.add_argument("--format", choices=["json", "delimited", "parquet"], default=None)
    p.add_argument("--rebuild", action="store_true", help="rebuild the clean table even if complete")
    part = p.add_mutually_exclusive_group()
    part.add_argument("--first-lines", type=int, default=None, help="read only so many lines (JSON lines)")
    part.add_argument("--max-rows", type=int, default=None, help="read only so many rows")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None, config: JobConfig | None = None) -> dict:
    args = parse(argv)
    spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
    work = args.work_dir.rstrip("/")
    use_checkpoint_dir(spark, f"{work}/checkpoint")
    config = config or JobConfig()
    config = replace(config, model_path=f"{work}/model", journal_path=f"{work}/journal")
    raw = readers.load_products(
        spark, args.source, fmt=args.format, keep_corrupt=True, first_lines=args.first_lines, max_rows=args.max_rows
    )
    source = part_of(args.source, args.first_lines, args.max_rows)
    result = run_job(spark, raw, config, clean_path=f"{work}/clean.parquet", reuse_clean=not args.rebuild, source=source)
    sinks.write_report(result.summary, f"{work}/summary.json")
    sinks.write_report(result.preview, f"{work}/preview.json")
    sinks.write_report(result.report, f"{work}/report.json")
    sinks.write_report(result.sweep, f"{work}/sweep.json")
    sinks.write_parquet(result.predictions, f"{work}/predictions.parquet")
    sinks.write_parquet(result.pca, f"{work}/pca_points.parquet")
    summary = {"k": result.k, "silhouette": result.silhouette, "choice": result.choice, "rows": result.counts}
    result.release()
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
