"""The whole job: clean → store → profile → trim → scale → sweep → fit → report.

Each stage is one of the operators; this module only wires them and decides
what is stored:

* the cleaned table is written once (Parquet) and read back, its row counts
  observed on that same write (no extra count jobs);
* the nine measures are persisted for the sequential quantile passes;
* the prepared table (all columns, ``features`` and ``scaled_features``) is
  written once; K-means, PCA and the evaluation share one persisted frame that
  holds its scaled vectors;
* with a journal (``JobConfig.journal_path``) the prepared table, each row of the sweep and the
  model are recorded as they are done, and a rerun of the same parameters on the same
  cleaned table goes on from there.

Written tables are where lineage is cut: everything after one is a short chain
of narrow steps, so a lost executor recomputes its blocks from that table.
"""

from __future__ import annotations

import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.config import CleanConfig, JobConfig
from tessera.functions.exprs import qcol
from tessera.operators import clustering, evaluate, features, pca, profile, quality
from tessera.plans.journal import Journal
from tessera.plans.wide import WIDE_KEYS, WIDE_MEASURES, load_wide
from tessera.session import persist_frame, remove_path, scratch_path, spread
from tessera.sources import readers, sinks

PREDICTION = clustering.PREDICTION_COL
#: Rows of one partition of the vectors, beyond ``JobConfig.partitions`` of them: known from the table, not the machine.
PARTITION_ROWS = 1_000_000


@dataclass
class JobResult:
    clean: DataFrame
    summary: DataFrame
    preview: DataFrame
    prepared: DataFrame
    bounds: list
    scaler: PipelineModel
    sweep: DataFrame
    choice: dict
    k: int
    model: KMeansModel
    predictions: DataFrame
    silhouette: float
    profile: DataFrame
    sizes: DataFrame
    minmax: DataFrame
    report: DataFrame
    pca: DataFrame
    counts: dict = field(default_factory=dict)
    timings: dict = field(default_factory=dict)
    cached: list[DataFrame] = field(default_factory=list)
    scratch: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Drop the cached frames and scratch tables the job keeps for its caller."""
        spark = self.clean.sparkSession
        for frame in self.cached:
            frame.unpersist()
        for path in self.scratch:
            remove_path(spark, path)


def clean_and_store(
    raw: DataFrame, config: CleanConfig, path: str, rebuild: bool = False, source: str = ""
) -> tuple[DataFrame, dict]:
    """Clean, write Parquet at ``path``, read back; counts observed on the write.

    A completed table of the same parameters and the same ``source`` (whatever names it) is
    reused (its counts then hold only its size). Rows a reader marked as malformed are counted and dropped.
    """
    counts: dict = {"rows_in": None, "rows_corrupt": None}

    def build() -> DataFrame:
        seen, kept = Observation("rows_in"), Observation("rows_clean")
        bad = F.col(readers.CORRUPT_COL).isNotNull() if readers.CORRUPT_COL in raw.columns else F.lit(False)
        counted = spread(raw).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
        good = readers.drop_corrupt(counted) if readers.CORRUPT_COL in raw.columns else counted
        observed.extend([seen, kept])
        return quality.clean_table(good, config).observe(kept, F.count(F.lit(1)).alias("n"))

    observed: list[Observation] = []
    clean = sinks.materialize(raw.sparkSession, path, build, key=f"{config!r} {source}".strip(), rebuild=rebuild)
    if observed:
        seen, kept = observed
        counts = {"rows_in": seen.get["n"], "rows_corrupt": seen.get["bad"], "rows_clean": kept.get["n"]}
    else:
        counts["rows_clean"] = clean.count()
    return clean, counts


def ingest(
    spark: SparkSession,
    source_path: str,
    sink_path: str,
    config: CleanConfig = CleanConfig(),
    fmt: str | None = None,
    reuse: bool = True,
    first_lines: int | None = None,
    max_rows: int | None = None,
) -> tuple[DataFrame, dict]:
    """Raw catalogue (JSON lines / delimited / Parquet) → cleaned Parquet table.

    Reads with declared schemas, cleans, writes ``sink_path`` once and reads it
    back; a completed table of the same parameters is reused when ``reuse``. ``first_lines``
    and ``max_rows`` take part of the source (see ``readers.load_products``).
    """
    raw = readers.load_products(
        spark, source_path, fmt=fmt, measures=config.measure_cols, descriptive=config.descriptive_cols, keep_corrupt=True,
        first_lines=first_lines, max_rows=max_rows,
    )
    return clean_and_store(raw, config, sink_path, rebuild=not reuse, source=part_of(source_path, first_lines, max_rows))


def part_of(source_path: str, first_lines: int | None = None, max_rows: int | None = None) -> str:
    """What names a source and the part of it that is read."""
    return f"{source_path} lines={first_lines} rows={max_rows}"


def prepare(clean: DataFrame, config: JobConfig, path: str) -> tuple[DataFrame, int, list, PipelineModel]:
    """Trim feature by feature, assemble and scale; every column of the clean
    table stays. Writes the prepared table at ``path``; returns it with its row
    count, the bounds and the fitted scaler."""
    cols = list(config.feature_cols)
    # The first quantile pass fills the cache, so no separate action here.
    narrow = persist_frame(clean.select(*[qcol(c) for c in cols]), eager=False)
    trimmed, bounds = features.outlier_trim(narrow, cols, config.trim)
    if len(bounds) < len(cols):
        # A quantile pass found no values: nothing survived cleaning.
        narrow.unpersist()
        raise ValueError("no rows left after cleaning; cannot scale or fit K-means")
    _, scaler = features.assemble_scale(trimmed, cols)
    whole = clean
    for c, lo, hi in bounds:
        whole = whole.filter(qcol(c).between(F.lit(lo), F.lit(hi)))
    rows = Observation("rows_prepared")
    sinks.write_parquet(scaler.transform(whole).observe(rows, F.count(F.lit(1)).alias("n")), path)
    narrow.unpersist()
    return clean.sparkSession.read.parquet(path), rows.get["n"], bounds, scaler


def prepare_once(clean: DataFrame, config: JobConfig, journal: Journal) -> tuple[DataFrame, int, list, PipelineModel]:
    """:func:`prepare`, or what the journal has of it."""
    path, scaler_path = journal.path("prepared.parquet"), journal.path("scaler")
    done = journal.get("prepared")
    if done:
        return clean.sparkSession.read.parquet(path), done["rows"], [tuple(b) for b in done["bounds"]], PipelineModel.load(scaler_path)
    prepared, rows, bounds, scaler = prepare(clean, config, path)
    scaler.write().overwrite().save(scaler_path)
    journal.put("prepared", {"rows": rows, "bounds": bounds})
    return prepared, rows, bounds, scaler


def open_journal(spark: SparkSession, config: JobConfig, clean_path: str | None) -> Journal | None:
    """The journal of these parameters and this version of the cleaned table."""
    if not config.journal_path:
        return None
    if not clean_path:
        raise ValueError("a journal needs a cleaned table that stays (clean_path)")
    version = sinks.modified(spark, f"{clean_path.rstrip('/')}/{sinks.COMMIT_MARK}")
    plain = replace(config, model_path=None, journal_path=None)
    return Journal(spark, config.journal_path, f"{plain!r} {clean_path} {version}")


def run_job(
    spark: SparkSession,
    raw: DataFrame,
    config: JobConfig,
    clean_path: str | None = None,
    reuse_clean: bool = True,
    source: str = "",
) -> JobResult:
    """Run every stage. With ``clean_path`` naming a completed table of the same
    parameters and ``source`` and ``reuse_clean``, ingest is skipped and that table is read, as
    a rerun of the job would do. Call ``release`` on the result when done."""
    timings: dict[str, float] = {}
    scratch: list[str] = []

    def stamp(name: str, t0: float) -> float:
        now = time.perf_counter()
        timings[name] = round(now - t0, 3)
        return now

    def own_path(name: str) -> str:
        scratch.append(scratch_path(spark, name))
        return scratch[-1]

    cols = list(config.feature_cols)
    t = time.perf_counter()
    clean, counts = clean_and_store(raw, config.clean, clean_path or own_path("clean.parquet"), rebuild=not reuse_clean, source=source)
    t = stamp("ingest_clean", t)

    summary = profile.summary_stats(clean, cols, config.trim.relative_error)
    order = [c for c in clean.columns if c not in cols] + cols
    preview = profile.preview(clean, config.preview_rows, order)
    t = stamp("profile", t)

    journal = open_journal(spark, config, clean_path)
    if journal:
        prepared, counts["rows_prepared"], bounds, scaler = prepare_once(clean, config, journal)
    else:
        prepared, counts["rows_prepared"], bounds, scaler = prepare(clean, config, own_path("prepared.parquet"))
    if counts["rows_prepared"] == 0:
        raise ValueError("no rows left after cleaning and trimming; cannot fit K-means")
    partitions = max(config.partitions, math.ceil(counts["rows_prepared"] / PARTITION_ROWS))
    vectors = persist_frame(prepared.select(features.SCALED_COL).repartition(partitions), StorageLevel.DISK_ONLY)
    blocks = clustering.stack_rows(vectors, features.SCALED_COL)
    t = stamp("trim_scale", t)

    ks = range(config.sweep.min_k, config.sweep.max_k + 1)
    known = {k: tuple(row) for k in ks if journal and (row := journal.get(f"sweep-{k}"))}
    record = (lambda row, model: journal.put(f"sweep-{row[0]}", row)) if journal else None
    sweep = clustering.kmeans_sweep(vectors, features.SCALED_COL, config.sweep, known, record, blocks)
    choice = clustering.choose_k(sweep, config.choose).first().asDict()
    if choice["k_final"] is None:
        raise ValueError("no k of the sweep has a defined silhouette (too few distinct rows)")
    k = int(choice["k_final"])
    t = stamp("sweep", t)

    if journal and journal.get("model"):
        model = sinks.load_kmeans(journal.path("model"))
    else:
        model = clustering.fit_kmeans(vectors, k, features.SCALED_COL, config.fit, blocks=blocks)
        if journal:
            sinks.save_model(model, journal.path("model"))
            journal.put("model", {"k": k})
    blocks.unpersist()
    if config.model_path:
        sinks.save_model(model, config.model_path)
    t = stamp("final_fit", t)

    predictions = model.transform(prepared)
    # Silhouette, the per-cluster aggregation and the PCA axes only need the
    # model and the stored vectors: they run as concurrent Spark jobs.
    sizes_and_means = evaluate.cluster_report(predictions, PREDICTION, k, 0.0, cols).persist()

    def timed(fn):
        def run():
            t0 = time.perf_counter()
            out = fn()
            return out, round(time.perf_counter() - t0, 3)

        return run

    with ThreadPoolExecutor(max_workers=3) as pool:
        sil_f = pool.submit(timed(lambda: clustering.silhouette(model.transform(vectors), features.SCALED_COL, PREDICTION)))
        agg_f = pool.submit(timed(sizes_and_means.count))
        pca_f = pool.submit(
            timed(lambda: pca.principal_components(vectors, features.SCALED_COL, config.pca_components))
        )
        (score, timings["silhouette"]), (_, timings["analysis"]), (axes, timings["pca"]) = (
            sil_f.result(), agg_f.result(), pca_f.result()
        )
    report = sizes_and_means.withColumn("silhouette", F.lit(float(score)))
    means = report.select(PREDICTION, *[f"{evaluate.AVG_PREFIX}{c}" for c in cols])
    sizes = report.select(PREDICTION, F.col("size").alias("count")).orderBy(PREDICTION)
    minmax = evaluate.minmax_normalise(means, PREDICTION)
    keys = [c for c in clean.columns if c not in cols]
    points = pca.pca_points(predictions, features.SCALED_COL, [PREDICTION, *keys], axes=axes)
    stamp("evaluate", t)

    return JobResult(
        clean=clean, summary=summary, preview=preview, prepared=prepared, bounds=bounds, scaler=scaler, sweep=sweep,
        choice=choice, k=k, model=model, predictions=predictions, silhouette=score, profile=means, sizes=sizes,
        minmax=minmax, report=report, pca=points, counts=counts, timings=timings,
        cached=[vectors, sizes_and_means], scratch=scratch,
    )


# The job on wide_facts (lineitem with injected gaps): the driver's stand-in
# for the nine-measure catalogue.
WIDE_JOB = JobConfig(
    feature_cols=WIDE_MEASURES,
    clean=CleanConfig(measure_cols=WIDE_MEASURES, descriptive_cols=WIDE_KEYS, descriptive_type=None),
    partitions=8,
)


def cluster_report_query(spark: SparkSession, sf_dir: str, config: JobConfig = WIDE_JOB) -> DataFrame:
    """Run the whole job on ``wide_facts`` of ``sf_dir``; the per-cluster report
    (k rows, which is all that is left when the job's tables are released)."""
    result = run_job(spark, load_wide(spark, sf_dir), config)
    report = spark.createDataFrame(result.report.collect(), result.report.schema)
    result.release()
    return report
