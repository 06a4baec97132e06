import os
from dataclasses import replace

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tessera.config import CleanConfig, SweepConfig, TrimConfig
from tessera.plans.job import WIDE_JOB, ingest, run_job
from tessera.plans.wide import WIDE_KEYS, load_wide

SHORT = replace(WIDE_JOB, sweep=SweepConfig(min_k=2, max_k=4, max_iter=5))


def test_whole_job_invariants(spark, tmp_dir):
    config = replace(WIDE_JOB, model_path=os.path.join(tmp_dir, "model"))
    wide = load_wide(spark, SF_SMALL)
    result = run_job(spark, wide, config)
    counts = result.counts
    assert counts["rows_in"] == wide.count() and counts["rows_corrupt"] == 0
    assert counts["rows_clean"] == result.clean.count() and counts["rows_prepared"] == result.prepared.count() > 0
    sweep = result.sweep.orderBy("k").collect()
    assert [r["k"] for r in sweep] == list(range(2, 16))
    assert all(-1 <= r["silhouette"] <= 1 for r in sweep)
    assert result.k == (4 if result.choice["k_silhouette"] <= 3 else result.choice["k_silhouette"])
    report = result.report.collect()
    assert sum(r["size"] for r in report) == counts["rows_prepared"]
    assert {r["k"] for r in report} == {result.k}
    assert -1 <= result.silhouette <= 1
    assert result.pca.count() == counts["rows_prepared"]
    assert result.pca.columns == ["x", "y", "prediction", *WIDE_KEYS]
    norm = result.minmax.agg(*[F.min(c).alias(c) for c in result.minmax.columns if c != "prediction"]).first()
    assert all(v == 0.0 for v in norm)
    assert os.path.exists(os.path.join(tmp_dir, "model", "metadata"))
    # The cleaned table has no gaps left.
    clean = result.clean
    assert clean.filter(" OR ".join(f"{c} IS NULL OR isnan({c})" for c in WIDE_JOB.feature_cols)).count() == 0
    assert {r["column"] for r in result.summary.collect()} == set(WIDE_JOB.feature_cols)
    order = [*WIDE_KEYS, *WIDE_JOB.feature_cols]
    assert [tuple(r) for r in result.preview.collect()] == [tuple(r) for r in clean.orderBy(*order).limit(20).collect()]
    paths = [p.removeprefix("file:") for p in result.scratch]
    assert all(os.path.exists(p) for p in paths)
    result.release()
    assert not any(f.is_cached for f in result.cached) and not any(os.path.exists(p) for p in paths)


def test_predictions_carry_ids_and_every_column(spark):
    result = run_job(spark, load_wide(spark, SF_SMALL), replace(SHORT, trim=TrimConfig(relative_error=0.0)))
    cols = [*WIDE_KEYS, *WIDE_JOB.feature_cols]
    assert result.prepared.columns == [*cols, "features", "scaled_features"]
    assert result.predictions.columns == [*result.prepared.columns, "prediction"]
    kept = result.clean
    for c, lo, hi in result.bounds:
        kept = kept.filter(F.col(c).between(lo, hi))
    assert kept.select(cols).exceptAll(result.predictions.select(cols)).count() == 0
    assert result.predictions.count() == kept.count()
    result.release()


def test_job_reuses_a_completed_clean_table_of_the_same_parameters(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clean.parquet")
    first = run_job(spark, load_wide(spark, SF_SMALL), SHORT, clean_path=path)
    assert first.counts["rows_in"] is not None
    # The raw frame is not read again: an empty stand-in gives the same result.
    empty = load_wide(spark, SF_SMALL).limit(0)
    second = run_job(spark, empty, SHORT, clean_path=path)
    assert second.counts["rows_in"] is None
    assert second.counts["rows_clean"] == first.counts["rows_clean"]
    assert second.counts["rows_prepared"] == first.counts["rows_prepared"]
    # Other clean parameters rebuild the table.
    strict = replace(SHORT, clean=replace(SHORT.clean, min_valid=8))
    third = run_job(spark, load_wide(spark, SF_SMALL), strict, clean_path=path)
    assert third.counts["rows_in"] == first.counts["rows_in"] and third.counts["rows_clean"] < first.counts["rows_clean"]
    for result in (first, second, third):
        result.release()


def test_journal_goes_on_where_a_run_ended(spark, tmp_dir, monkeypatch):
    import pytest

    from tessera.operators import clustering, features
    from tessera.plans import job

    config = replace(SHORT, sweep=SweepConfig(min_k=2, max_k=6, max_iter=4, parallelism=1), journal_path=os.path.join(tmp_dir, "journal"))
    path = os.path.join(tmp_dir, "clean.parquet")
    wide = load_wide(spark, SF_SMALL)
    fits, trims, stop = [], [], {"at": 5}
    fit, trim = clustering.KMeans.fit, features.outlier_trim

    def counted(self, *args):
        if self.getK() == stop["at"]:
            raise RuntimeError("executor lost")
        fits.append(self.getK())
        return fit(self, *args)

    monkeypatch.setattr(clustering.KMeans, "fit", counted)
    monkeypatch.setattr(job.features, "outlier_trim", lambda *a: trims.append(1) or trim(*a))
    with pytest.raises(RuntimeError, match="lost"):
        run_job(spark, wide, config, clean_path=path)
    assert 4 in fits and 5 not in fits and trims == [1]
    done, stop["at"] = sorted(set(fits) - {6}), None
    fits.clear()
    second = run_job(spark, wide, config, clean_path=path)
    assert not set(done) & set(fits[:-1]) and fits[0] == 5 and trims == [1]
    fits.clear()
    third = run_job(spark, wide, config, clean_path=path)
    assert fits == [] and third.k == second.k and third.counts["rows_prepared"] == second.counts["rows_prepared"]
    assert [tuple(r) for r in third.sweep.collect()] == [tuple(r) for r in second.sweep.collect()]
    assert third.report.select("prediction", "size").exceptAll(second.report.select("prediction", "size")).count() == 0
    # other parameters, or a new cleaned table, begin anew
    other = run_job(spark, wide, replace(config, trim=TrimConfig(relative_error=0.0)), clean_path=path)
    assert fits and len(trims) == 2
    fits.clear()
    again = run_job(spark, wide, config, clean_path=path, reuse_clean=False)
    assert fits and len(trims) == 3
    for result in (second, third, other, again):
        result.release()
    with pytest.raises(ValueError, match="clean_path"):
        run_job(spark, wide, config)


ROWS = [
    '{"_id": "1", "product_name": "a", "nutriments": {"energy_100g": 100, "proteins_100g": 2, '
    '"carbohydrates_100g": 3, "sugars_100g": 4, "fat_100g": 5}}',
    '{"_id": "2", "product_name": "b", "nutriments": {"energy_100g": 100}}',
    "broken{",
]


def test_ingest_json_to_clean_table_and_reuse(spark, tmp_dir):
    src = os.path.join(tmp_dir, "products.json")
    with open(src, "w") as fh:
        fh.write("\n".join(ROWS) + "\n")
    sink = os.path.join(tmp_dir, "clean.parquet")
    clean, counts = ingest(spark, src, sink, CleanConfig())
    assert counts == {"rows_in": 3, "rows_corrupt": 1, "rows_clean": 1}
    assert clean.first()["_id"] == "1" and clean.first()["fiber_100g"] == 0.0
    again, counts2 = ingest(spark, src, sink, CleanConfig())
    assert counts2 == {"rows_in": None, "rows_corrupt": None, "rows_clean": 1}
    _, counts3 = ingest(spark, src, sink, CleanConfig(), reuse=False)
    assert counts3 == counts


def test_ingest_delimited_counts_malformed_rows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "products.tsv")
    with open(src, "w") as fh:
        fh.write("code\tenergy_100g\tproteins_100g\tfat_100g\tsalt_100g\tsodium_100g\n")
        fh.write("1\t1\t2\t3\t4\t5\n2\t1\n3\t1\t2\t3\t4\t5\t6\t7\n")
    clean, counts = ingest(spark, src, os.path.join(tmp_dir, "clean.parquet"), CleanConfig())
    assert counts == {"rows_in": 3, "rows_corrupt": 2, "rows_clean": 1}
    assert [r["_id"] for r in clean.collect()] == ["1"]


def test_partitions_of_the_vectors_grow_with_the_rows(spark, monkeypatch):
    from tessera.plans import job

    monkeypatch.setattr(job, "PARTITION_ROWS", 400)
    result = run_job(spark, load_wide(spark, SF_SMALL), replace(SHORT, sweep=SweepConfig(min_k=2, max_k=3, max_iter=2)))
    assert result.cached[0].rdd.getNumPartitions() == -(-result.counts["rows_prepared"] // 400) > WIDE_JOB.partitions
    assert result.predictions.count() == result.counts["rows_prepared"]
    result.release()


def test_stored_tables_are_read_by_more_tasks_than_wrote_them(spark, tmp_dir, monkeypatch):
    from tessera.sources import sinks

    monkeypatch.setattr(sinks, "ROW_GROUP_BYTES", 16 << 10, raising=False)
    rows = spark.range(200_000).select("id", F.rand(1).alias("x")).coalesce(1)
    stored = sinks.materialize(spark, os.path.join(tmp_dir, "one.parquet"), lambda: rows)
    assert len(stored.inputFiles()) == 1
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        sizes = [r["count"] for r in spark.read.parquet(stored.inputFiles()[0]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sum(sizes) == 200_000 and len(sizes) > 4 and max(sizes) < 60_000


def test_vectors_of_the_job_take_no_memory_between_passes(spark):
    result = run_job(spark, load_wide(spark, SF_SMALL), replace(SHORT, sweep=SweepConfig(min_k=2, max_k=3, max_iter=2)))
    level = result.cached[0].storageLevel
    assert level.useDisk and not level.useMemory
    result.release()
