"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each reads the driver's tables (or files Spark writes from them) in full and
exercises one operator family; the matching DuckDB SQL lives in
:mod:`tessera.plans.oracle`. Computed doubles whose value depends on summation
order are rounded to 6 places, on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import PRODUCT_MEASURE_STRUCT, ChooseConfig, CleanConfig, FitConfig, SweepConfig, TrimConfig
from tessera.operators import clustering, evaluate, features, pca, profile, quality
from tessera.plans import job
from tessera.plans.wide import WIDE_KEYS, WIDE_MEASURES, load_wide, table, wide_facts
from tessera.session import cut_lineage, persist_frame, scratch_path, spread
from tessera.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]

LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
EXACT_TRIM = TrimConfig(relative_error=0.0)
WIDE_CLEAN = CleanConfig(
    measure_cols=WIDE_MEASURES, descriptive_cols=WIDE_KEYS, descriptive_type=None
)
# Flat catalogue-like layout written from wide_facts for the text readers.
TEXT_DESCRIPTIVE = ("_id", "product_name")
TEXT_CLEAN = CleanConfig(measure_cols=WIDE_MEASURES, descriptive_cols=TEXT_DESCRIPTIVE)


def _r6(c):
    return F.round(c, 6)


def _clean_wide(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean_table(load_wide(spark, sf), WIDE_CLEAN)


def _catalogue_rows(spark: SparkSession, sf: str) -> DataFrame:
    """wide_facts in the flat catalogue layout: string id, name, measures."""
    wide = load_wide(spark, sf)
    return wide.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("_id"),
        F.col("l_returnflag").alias("product_name"),
        *WIDE_MEASURES,
    )


# --- sources / sinks --------------------------------------------------------

def q_parquet_scan(spark, sf):
    return readers.read_parquet(
        spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", *LINE_MEASURES]
    )


def q_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "clean.parquet")
    sinks.write_parquet(_clean_wide(spark, sf), path)
    return spark.read.parquet(path)


def _must_not_rebuild() -> DataFrame:
    raise RuntimeError("materialize rebuilt a completed table")


def q_materialize_once(spark, sf):
    path = scratch_path(spark, "clean.parquet")
    first = sinks.materialize(spark, path, lambda: _clean_wide(spark, sf))
    # Second call finds the completed table and only reads it.
    second = sinks.materialize(spark, path, _must_not_rebuild)
    assert first.schema == second.schema
    return second


def q_json_nested_scan(spark, sf):
    path = scratch_path(spark, "catalogue.json")
    rows = _catalogue_rows(spark, sf)
    nested = rows.select(*TEXT_DESCRIPTIVE, F.struct(*WIDE_MEASURES).alias(PRODUCT_MEASURE_STRUCT))
    nested.write.mode("overwrite").json(path)
    flat = readers.load_products(
        spark, path, fmt="json", measures=WIDE_MEASURES, descriptive=TEXT_DESCRIPTIVE
    )
    return quality.clean_table(flat, TEXT_CLEAN)


def _delimited_scan(spark, sf, sep):
    path = scratch_path(spark, "catalogue.csv")
    rows = _catalogue_rows(spark, sf).withColumnRenamed("_id", "code")
    rows.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    flat = readers.load_products(
        spark, path, fmt="delimited", measures=WIDE_MEASURES, descriptive=TEXT_DESCRIPTIVE,
        renames={"code": "_id"},
    )
    return quality.clean_table(flat, TEXT_CLEAN)


def q_csv_tab_scan(spark, sf):
    return _delimited_scan(spark, sf, "\t")


def q_csv_comma_scan(spark, sf):
    return _delimited_scan(spark, sf, ",")


# Every lineitem column that wide_facts reads: rows equal in these are equal there.
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
LINES_WANTED = 20_000
ROWS_WANTED = 10_000
#: Rows of one file that a query writes, so that a task sorts or writes no more of a larger table.
FILE_ROWS = 1_000_000


def _files(rows: DataFrame, least: int) -> int:
    """Files for a stored table: ``least``, and more as it grows (its row count is in its footers)."""
    return max(least, math.ceil(rows.count() / FILE_ROWS))


def _write_json_lines(spark, sf, line) -> str:
    """JSON lines of the catalogue in the order of ``LINE_ORDER``, over several files."""
    path = scratch_path(spark, "catalogue.json")
    lineitem = table(spark, sf, "lineitem")
    ordered = wide_facts(lineitem.repartitionByRange(_files(lineitem, 4), *LINE_ORDER).sortWithinPartitions(*LINE_ORDER))
    ordered.select(line.alias("value")).write.text(path)
    return path


def _catalogue_id():
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def _catalogue_json():
    measures = F.struct(*WIDE_MEASURES).alias(PRODUCT_MEASURE_STRUCT)
    return F.to_json(F.struct(_catalogue_id().alias("_id"), F.col("l_returnflag").alias("product_name"), measures))


def q_first_lines(spark, sf):
    """The rows of exactly the first lines of a JSON export of several files."""
    path = _write_json_lines(spark, sf, _catalogue_json())
    raw = readers.load_products(
        spark, path, fmt="json", measures=WIDE_MEASURES, descriptive=TEXT_DESCRIPTIVE, first_lines=LINES_WANTED
    )
    return quality.cast_double(raw, WIDE_MEASURES).select("_id", "product_name", "f1", "f3", "f8")


def q_row_cap(spark, sf):
    """What a capped read of ``lineitem`` holds: so many rows, all of the table."""
    path = scratch_path(spark, "lineitem.parquet")
    lineitem = table(spark, sf, "lineitem")
    lineitem.repartition(_files(lineitem, 6), "l_orderkey").write.parquet(path)
    whole = spark.read.parquet(path)
    capped = readers.load_products(spark, path, fmt="parquet", max_rows=ROWS_WANTED)
    rows = capped.groupBy(*LINE_ORDER).agg(F.count(F.lit(1)).alias("n"))
    # the table's rows are counted where the cap took an equal one: a task holds counts of no more than the cap
    same = whole.join(F.broadcast(rows.select(*LINE_ORDER)), list(LINE_ORDER), "left_semi")
    known = same.groupBy(*LINE_ORDER).agg(F.count(F.lit(1)).alias("there"))
    return rows.join(known, list(LINE_ORDER), "left").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("n") <= F.col("there"), F.col("n"))), F.lit(0)).alias("rows_of_the_table")
    )


def q_json_quarantine(spark, sf):
    """Malformed lines of a JSON export with their numbers, and the rows that are whole."""
    broken = F.concat(F.lit("{broken "), _catalogue_id())
    path = _write_json_lines(spark, sf, F.when(F.col("l_orderkey") % 17 == 0, broken).otherwise(_catalogue_json()))
    schema = readers.nested_schema(TEXT_DESCRIPTIVE, PRODUCT_MEASURE_STRUCT, WIDE_MEASURES)
    good, bad = readers.quarantine_json(spark, path, schema, scratch_path(spark, "split.parquet"))
    rows = good.where("_id IS NOT NULL").agg(F.count(F.lit(1)).alias("whole_rows"))
    return bad.select("number", "text").join(rows, how="left")


def q_cluster_report(spark, sf):
    lab = table(spark, sf, "embeddings")
    n = lab.select("label").distinct().count()
    score = clustering.silhouette(lab, "embedding", "label")
    report = evaluate.cluster_report(lab, "label", n, score)
    path = scratch_path(spark, "report.json")
    sinks.write_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    return back.select("label", "size", "k", _r6(F.col("silhouette")).alias("silhouette"))


# --- projections / quality ----------------------------------------------------

def q_rename_map(spark, sf):
    li = table(spark, sf, "lineitem")
    renamed = quality.rename_columns(
        li, {"l_quantity": "quantity", "l_extendedprice": "extended_price", "l_not_there": "ignored"}
    )
    return renamed.select("l_orderkey", "l_linenumber", "quantity", "extended_price")


def q_add_missing_cols(spark, sf):
    partial = load_wide(spark, sf).select("l_orderkey", "l_linenumber", "f1", "f3", "f4")
    full = quality.add_missing_columns(partial, WIDE_MEASURES, "double")
    return full.select("l_orderkey", "l_linenumber", "f1", "f7", "f8", "f9")


def q_conform_schema(spark, sf):
    rows = _catalogue_rows(spark, sf).select("_id", "product_name", "f1", "f3")
    return quality.conform(
        rows,
        [("_id", "string"), ("product_name", "string"), ("brands", "string"), ("f1", "double"), ("f3", "double")],
    )


def q_cast_clean(spark, sf):
    ev = table(spark, sf, "events")
    text = F.substring_index(F.substring_index(F.col("props"), ": ", -1), "}", 1)
    raw = ev.select("event_id", "value", text.alias("k"), F.col("event_type").alias("bad"))
    return quality.cast_double(raw, ["k", "bad"])


def q_validity_count(spark, sf):
    flagged = quality.with_valid_count(load_wide(spark, sf), WIDE_MEASURES)
    return flagged.groupBy("n_valid").agg(F.count(F.lit(1)).alias("n_rows"))


def q_quality_filter(spark, sf):
    wide = load_wide(spark, sf)
    kept = quality.filter_min_valid(wide, WIDE_MEASURES, WIDE_CLEAN.min_valid)
    return quality.with_valid_count(kept, WIDE_MEASURES).select(*WIDE_KEYS, "n_valid")


def q_impute_zero(spark, sf):
    return _clean_wide(spark, sf)


# --- profiling ----------------------------------------------------------------

def q_stage_counts(spark, sf):
    """Rows after each stage, as the job counts them: observed on its writes."""
    clean, counts = job.clean_and_store(load_wide(spark, sf), WIDE_CLEAN, scratch_path(spark, "clean.parquet"))
    _, prepared, _, _ = job.prepare(clean, EXACT_JOB, scratch_path(spark, "prepared.parquet"))
    rows = [(counts["rows_in"], counts["rows_clean"], prepared)]
    return spark.createDataFrame(rows, "rows_in long, rows_valid long, rows_trimmed long")


def q_summary_stats(spark, sf):
    stats = profile.summary_stats(table(spark, sf, "lineitem"), LINE_MEASURES, relative_error=0.0)
    return stats.withColumns({"mean": _r6(F.col("mean")), "stddev": _r6(F.col("stddev"))})


def q_quantile_bounds(spark, sf):
    return profile.quantile_bounds(
        table(spark, sf, "lineitem"), LINE_MEASURES, EXACT_TRIM.probabilities, relative_error=0.0
    )


def q_word_count(spark, sf):
    return profile.word_count(table(spark, sf, "documents"), "text", " ")


def q_n_clusters(spark, sf):
    return profile.distinct_count(table(spark, sf, "embeddings"), "label", "n_clusters")


def q_cluster_sizes(spark, sf):
    return evaluate.cluster_sizes(table(spark, sf, "embeddings"), "label")


def q_format_stats(spark, sf):
    means = evaluate.cluster_profile(table(spark, sf, "lineitem"), LINE_MEASURES, "l_returnflag")
    return evaluate.format_profile(means, "l_returnflag")


def q_plain_format(spark, sf):
    means = evaluate.cluster_profile(table(spark, sf, "lineitem"), LINE_MEASURES, "l_returnflag")
    text = evaluate.format_profile(means, "l_returnflag", grouped=False)
    names = [f"avg_{c}" for c in LINE_MEASURES]
    back = quality.cast_double(text, names).withColumnsRenamed({n: f"num_{n}" for n in names})
    return text.join(back, "l_returnflag")


def q_preview(spark, sf):
    return profile.preview(_clean_wide(spark, sf), 20, [*WIDE_KEYS, *WIDE_MEASURES])


# --- features -----------------------------------------------------------------

def q_outlier_trim(spark, sf):
    clean = cut_lineage(spread(_clean_wide(spark, sf).select("l_orderkey", "l_linenumber", *WIDE_MEASURES)))
    trimmed, _ = features.outlier_trim(clean, WIDE_MEASURES, EXACT_TRIM)
    return trimmed


def q_assemble_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    scaled, _ = features.assemble_scale(li, LINE_MEASURES)
    out = features.scaled_columns(scaled, LINE_MEASURES)
    return out.select(
        "l_orderkey", "l_linenumber", *[_r6(F.col(f"s_{c}")).alias(f"s_{c}") for c in LINE_MEASURES]
    )


def q_cov_matrix(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_MEASURES)
    scaled, _ = features.assemble_scale(li, LINE_MEASURES)
    cols = features.scaled_columns(scaled, LINE_MEASURES, prefix="")
    cov = pca.covariance_matrix(cols.select(*LINE_MEASURES), LINE_MEASURES)
    return cov.withColumn("cov", _r6(F.col("cov")))


# --- clustering with given labels / centres ------------------------------------

def _lab(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


def q_cluster_profile(spark, sf):
    prof = evaluate.cluster_profile(_clean_wide(spark, sf), WIDE_MEASURES, "l_returnflag")
    return prof.select("l_returnflag", *[_r6(F.col(f"avg_{c}")).alias(f"avg_{c}") for c in WIDE_MEASURES])


def q_cluster_minmax(spark, sf):
    means = evaluate.cluster_profile(table(spark, sf, "lineitem"), LINE_MEASURES, "l_returnflag")
    norm = evaluate.minmax_normalise(means, "l_returnflag")
    return norm.select("l_returnflag", *[_r6(F.col(f"avg_{c}")).alias(f"avg_{c}") for c in LINE_MEASURES])


def q_assign_nearest(spark, sf):
    lab = _lab(spark, sf)
    centres = clustering.collect_centres(clustering.centroids(lab, "embedding", "label"))
    return clustering.assign_nearest(lab, "embedding", centres).select("vec_id", "prediction")


def q_wssse(spark, sf):
    lab = _lab(spark, sf)
    centres = clustering.centroids(lab, "embedding", "label")
    return clustering.wssse(lab, "embedding", "label", centres).select(_r6(F.col("wssse")).alias("wssse"))


def q_silhouette(spark, sf):
    lab = _lab(spark, sf)
    return spark.createDataFrame([(round(clustering.silhouette(lab, "embedding", "label"), 6),)], "silhouette double")


def q_cluster_filter(spark, sf):
    lab = _lab(spark, sf)
    return evaluate.one_cluster(lab, "label", 3).select("vec_id", "label")


def seeded_sweep(lab: DataFrame) -> DataFrame:
    """(k, wssse, silhouette) for k = 2..L: centres are the means of the k
    smallest labels and rows go to the nearest of them."""
    lab = cut_lineage(lab)
    centres = clustering.collect_centres(clustering.centroids(lab, "embedding", "label"))
    rows = []
    for k in range(2, len(centres) + 1):
        near = clustering.assign_nearest(lab, "embedding", centres[:k])
        cost = clustering.wssse(near, "embedding", "prediction", centres[:k]).first()[0]
        rows.append((k, cost, clustering.silhouette(near, "embedding", "prediction")))
    return lab.sparkSession.createDataFrame(rows, "k int, wssse double, silhouette double")


def q_choose_k(spark, sf):
    return clustering.choose_k(seeded_sweep(_lab(spark, sf)), ChooseConfig())


# --- K-means: results depend on layout, so the queries return facts that hold
# for every right result and that SQL can derive from the table --------------

EXACT_JOB = replace(job.WIDE_JOB, trim=EXACT_TRIM)


def _scaled_lab(spark, sf):
    """Embeddings of known length as columns, scaled by the library's own step."""
    lab = _lab(spark, sf)
    size = lab.select(F.size("embedding")).first()[0]
    names = [f"e{i}" for i in range(size)]
    wide = lab.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    scaled, _ = features.assemble_scale(wide, names)
    return cut_lineage(scaled.select("vec_id", "label", features.SCALED_COL))


def q_kmeans_sweep(spark, sf):
    """One row per k with what must hold: the cost of one cluster (of standardised columns, so
    SQL knows it), whether the sweep's cost is below it, whether the cost of all rows to their
    nearest centre is no more than the cost of the fit, and whether the sweep's silhouette is that of
    these nearest centres."""
    vectors = persist_frame(_scaled_lab(spark, sf).select(features.SCALED_COL))
    facts: dict[int, tuple] = {}

    def recompute(row, model):
        centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
        near = clustering.assign_nearest(vectors, features.SCALED_COL, centres, distance_col="d")
        facts[row[0]] = near.agg(F.sum("d")).first()[0], clustering.silhouette(near, features.SCALED_COL)

    swept = clustering.kmeans_sweep(vectors, features.SCALED_COL, SweepConfig(), record=recompute)
    origin = clustering.squared_distance(clustering.as_array(vectors, features.SCALED_COL), F.array(*[F.lit(0.0)] * len(vectors.first()[0])))
    one_cluster = vectors.agg(F.sum(origin)).first()[0]
    vectors.unpersist()
    again = spark.createDataFrame([(k, *v) for k, v in sorted(facts.items())], "k int, cost double, score double")
    return swept.join(again, "k").select(
        "k",
        F.round(F.lit(one_cluster), 4).alias("one_cluster_cost"),
        (F.col("wssse") < F.lit(one_cluster)).alias("below_one_cluster"),
        (F.col("cost") <= F.col("wssse") * (1 + 1e-9)).alias("nearest_costs_no_more"),
        (F.abs(F.col("silhouette") - F.col("score")) < 1e-9).alias("silhouette_of_nearest"),
        F.col("iterations").between(1, SweepConfig().max_iter).alias("iterations_in_range"),
    )


def _fitted(spark, sf):
    data = _scaled_lab(spark, sf)
    k = data.select("label").distinct().count()
    return data, clustering.fit_kmeans(data, k, "scaled_features", FitConfig())


def q_kmeans_fit(spark, sf):
    """Rows labelled, centres, and rows whose label is not the nearest centre's."""
    data, model = _fitted(spark, sf)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    checked = clustering.assign_nearest(model.transform(data), "scaled_features", centres, prediction_col="nearest")
    return checked.agg(
        F.count("prediction").alias("n_rows"),
        F.lit(len(centres)).cast("long").alias("n_centres"),
        F.count_if(F.col("nearest") != F.col("prediction")).alias("rows_off_nearest"),
    )


def q_model_roundtrip(spark, sf):
    """Centres of a saved and reloaded model, and the largest change."""
    _, model = _fitted(spark, sf)
    path = scratch_path(spark, "kmeans_model")
    sinks.save_model(model, path)
    was = clustering.model_centres(model).withColumnRenamed("centre", "was")
    both = clustering.model_centres(sinks.load_kmeans(path)).join(was, "cluster")
    gap = F.array_max(F.zip_with("centre", "was", lambda a, b: F.abs(a - b)))
    return both.agg(F.count(F.lit(1)).alias("n_centres"), F.max(gap).alias("largest_change"))


def q_pca_points(spark, sf):
    """The projected ``lineitem`` measures: both axes are centred, uncorrelated,
    ordered, and each satisfies C v = lambda v (largest residual, rounded)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    scaled, _ = features.assemble_scale(li, LINE_MEASURES)
    wide = features.scaled_columns(scaled, LINE_MEASURES)
    axes = pca.principal_components(scaled, features.SCALED_COL)
    names = [f"s_{c}" for c in LINE_MEASURES]
    points = pca.pca_points(wide, features.SCALED_COL, ["l_orderkey", "l_linenumber", *names], axes=axes)
    residual = [
        F.abs(F.covar_samp(axis, name) - F.var_samp(axis) * F.lit(v))
        for axis, loading in zip(("x", "y"), axes.loadings(), strict=True)
        for name, v in zip(names, loading, strict=True)
    ]
    return points.agg(
        F.count(F.lit(1)).alias("n_points"),
        F.abs(_r6(F.avg("x"))).alias("mean_x"),
        F.abs(_r6(F.avg("y"))).alias("mean_y"),
        F.abs(_r6(F.covar_samp("x", "y"))).alias("cov_xy"),
        (F.var_samp("x") >= F.var_samp("y")).alias("ordered"),
        _r6(F.greatest(*residual)).alias("largest_residual"),
    )


def q_cluster_predictions(spark, sf):
    """Ids and measures of the job's predictions under the exact trim, and whether each label is
    that of the nearest centre."""
    result = job.run_job(spark, load_wide(spark, sf), EXACT_JOB)
    for frame in result.cached:
        # the predictions are of the stored table
        frame.unpersist()
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(result.model.clusterCenters())]
    checked = clustering.assign_nearest(result.predictions, features.SCALED_COL, centres, prediction_col="nearest")
    on_nearest = (F.col("nearest") == F.col("prediction")).alias("on_nearest")
    return checked.select("l_orderkey", "l_linenumber", *WIDE_MEASURES, on_nearest)


def q_cluster_job(spark, sf):
    """The whole job under the exact trim: rows by stage and in the report."""
    result = job.run_job(spark, load_wide(spark, sf), EXACT_JOB)
    sized = result.report.agg(F.sum("size"), F.count_if(F.col("k") == result.k)).first()
    counts = result.counts
    rows = [(counts["rows_in"], counts["rows_clean"], counts["rows_prepared"], sized[0], sized[1] == result.k, -1 <= result.silhouette <= 1)]
    result.release()
    return spark.createDataFrame(
        rows, "rows_in long, rows_clean long, rows_prepared long, rows_in_clusters long, one_row_a_cluster boolean, "
        "silhouette_in_range boolean"
    )


QUERIES: dict[str, Query] = {
    "parquet_scan": q_parquet_scan,
    "parquet_roundtrip": q_parquet_roundtrip,
    "materialize_once": q_materialize_once,
    "json_nested_scan": q_json_nested_scan,
    "csv_tab_scan": q_csv_tab_scan,
    "csv_comma_scan": q_csv_comma_scan,
    "first_lines": q_first_lines,
    "row_cap": q_row_cap,
    "json_quarantine": q_json_quarantine,
    "rename_map": q_rename_map,
    "add_missing_cols": q_add_missing_cols,
    "conform_schema": q_conform_schema,
    "cast_clean": q_cast_clean,
    "validity_count": q_validity_count,
    "quality_filter": q_quality_filter,
    "impute_zero": q_impute_zero,
    "stage_counts": q_stage_counts,
    "summary_stats": q_summary_stats,
    "quantile_bounds": q_quantile_bounds,
    "outlier_trim": q_outlier_trim,
    "assemble_scale": q_assemble_scale,
    "cov_matrix": q_cov_matrix,
    "word_count": q_word_count,
    "n_clusters": q_n_clusters,
    "cluster_sizes": q_cluster_sizes,
    "cluster_profile": q_cluster_profile,
    "cluster_minmax": q_cluster_minmax,
    "format_stats": q_format_stats,
    "cluster_report": q_cluster_report,
    "assign_nearest": q_assign_nearest,
    "wssse": q_wssse,
    "silhouette": q_silhouette,
    "choose_k": q_choose_k,
    "kmeans_sweep": q_kmeans_sweep,
    "kmeans_fit": q_kmeans_fit,
    "model_roundtrip": q_model_roundtrip,
    "pca_points": q_pca_points,
    "preview": q_preview,
    "plain_format": q_plain_format,
    "cluster_filter": q_cluster_filter,
    "cluster_predictions": q_cluster_predictions,
    "cluster_job": q_cluster_job,
}
