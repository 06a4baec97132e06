"""K-means from MLlib's first centres: sweep, final fit, nearest-centre assignment, WSSSE, choice of k."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import RDD, SparkContext
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tessera.config import ChooseConfig, FitConfig, SweepConfig
from tessera.operators import draws, lloyd

PREDICTION_COL = "prediction"
#: Centres of one constant; more of them make more constants of the same narrow map.
CENTRES_AT_ONCE = 1_024
#: MLlib's solver that the iterations of ``lloyd`` follow.
SOLVER = "block"
#: Iterations of MLlib's k-means|| over its candidates.
RECLUSTER_ITERATIONS = 30


def as_vector(df: DataFrame, col: str) -> Column:
    """A vector column from either a vector or an array column."""
    if isinstance(df.schema[col].dataType, ArrayType):
        return array_to_vector(F.col(col))
    return F.col(col)


def as_array(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, ArrayType):
        return F.col(col).cast("array<double>")
    return vector_to_array(F.col(col))


def silhouette(df: DataFrame, features_col: str, prediction_col: str = PREDICTION_COL) -> float:
    """Mean silhouette with squared Euclidean distance (MLlib evaluator).

    Cost is O(n * k): per-cluster sums are aggregated once, then each point is
    scored against them; nothing is pairwise.
    """
    data = df.select(as_vector(df, features_col).alias("v"), F.col(prediction_col).cast("double").alias("p"))
    evaluator = ClusteringEvaluator(
        featuresCol="v", predictionCol="p", metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    return float(evaluator.evaluate(data))


def stack_rows(df: DataFrame, features_col: str) -> RDD:
    """The rows of ``df`` as blocks of doubles for fits and sweeps; the caller unpersists them."""
    return lloyd.stack(df, as_array(df, features_col))


Candidates = tuple[np.ndarray, np.ndarray]


class _Reclustering(KMeans):
    """What MLlib's k-means|| ends with: from weighted candidates to k first centres, on the driver."""

    def _fit(self, candidates: Candidates) -> KMeansModel:
        points, weights = candidates
        if len(points) <= self.getK():
            return _model(self, points)
        sc = SparkContext.getOrCreate()
        jvm, gateway = sc._jvm.org.apache.spark.mllib, sc._gateway
        given = gateway.new_array(jvm.clustering.VectorWithNorm, len(points))
        sizes = gateway.new_array(sc._jvm.double, len(points))
        for i, (point, weight) in enumerate(zip(points, weights, strict=True)):
            given[i], sizes[i] = jvm.clustering.VectorWithNorm(_old_vector(sc, point)), float(weight)
        chosen = jvm.clustering.LocalKMeans.kMeansPlusPlus(0, given, sizes, self.getK(), RECLUSTER_ITERATIONS)
        return _model(self, [list(c.vector().toArray()) for c in chosen])


def _candidates(df: DataFrame, features_col: str, blocks: RDD, ks: Sequence[int], steps: int, seed: int) -> dict[int, Candidates]:
    """MLlib's candidates for each k. Its first row is a sample of ``df``; the rest are passes over ``blocks``, the same rows."""
    number = draws.next_int(seed)
    sample = df.select(as_vector(df, features_col).alias("v"))._jdf.javaRDD().takeSample(False, 1, number)
    if not len(sample):
        raise ValueError("no rows to take first centres from")
    if sample[0].isNullAt(0):
        raise ValueError("vectors must not be null")
    first = np.array(list(sample[0].get(0).toArray()), dtype=float)
    return lloyd.candidates(blocks, first, ks, steps, number)


def _first_centres(kmeans: KMeans, candidates: Candidates) -> np.ndarray:
    """MLlib's k-means|| centres (fewer than k where there are fewer distinct rows)."""
    own = _Reclustering()
    kmeans._copyValues(own)
    return np.array([np.asarray(c, dtype=float) for c in own.fit(candidates).clusterCenters()])


def _at_once(df: DataFrame, parallelism: int) -> int:
    """So many of ``parallelism`` first centres at once as fill the cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(parallelism, parallelism * cores // max(1, df.rdd.getNumPartitions())))


def _old_vector(sc: SparkContext, values: Sequence[float]):
    row = sc._gateway.new_array(sc._jvm.double, len(values))
    for i, x in enumerate(values):
        row[i] = float(x)
    return sc._jvm.org.apache.spark.mllib.linalg.DenseVector(row)


def _model(kmeans: KMeans, centres: Sequence[Sequence[float]]) -> KMeansModel:
    """An MLlib model of ``centres`` with the parameters of ``kmeans``."""
    sc = SparkContext.getOrCreate()
    jvm, rows = sc._jvm, [_old_vector(sc, c) for c in centres]
    fitted = jvm.org.apache.spark.ml.clustering.KMeansModel(kmeans.uid, jvm.org.apache.spark.mllib.clustering.KMeansModel(rows))
    return kmeans._copyValues(KMeansModel(fitted))


def fit_kmeans(
    df: DataFrame,
    k: int,
    features_col: str,
    config: FitConfig = FitConfig(),
    prediction_col: str = PREDICTION_COL,
    blocks: RDD | None = None,
) -> KMeansModel:
    """Final K-means fit (k-means|| init, Euclidean): MLlib's first centres, then iterations, both over stacked
    rows (``blocks`` of :func:`stack_rows`, where the caller has them)."""
    kmeans = KMeans(
        k=k,
        seed=config.seed,
        featuresCol=features_col,
        predictionCol=prediction_col,
        maxIter=config.max_iter,
        tol=config.tol,
        initSteps=config.init_steps,
        solver=SOLVER,
    )
    own = stack_rows(df, features_col) if blocks is None else blocks
    first = _first_centres(kmeans, _candidates(df, features_col, own, [k], config.init_steps, config.seed)[k])
    fitted: dict[int, tuple] = {}
    lloyd.converge(own, {k: first}, config.max_iter, config.tol, fitted.update)
    if blocks is None:
        own.unpersist()
    return _model(kmeans, fitted[k][0])


SweepRow = tuple[int, float, float, int]


def kmeans_sweep(
    df: DataFrame,
    features_col: str,
    config: SweepConfig = SweepConfig(),
    known: Mapping[int, SweepRow] | None = None,
    record: Callable[[SweepRow, KMeansModel], None] | None = None,
    blocks: RDD | None = None,
) -> DataFrame:
    """(k, wssse, silhouette, iterations) for k = min_k..max_k, one row per k.

    The first centres of each k are MLlib's. Their candidates, the iterations and the silhouettes of all k share
    their passes over the stacked rows (``blocks`` of :func:`stack_rows`, where the caller has them). ``wssse`` is the
    cost in the last iteration, MLlib's training cost. Rows of ``known`` are not fitted again; ``record`` gets every
    other row and its model as it is done, and with it only ``config.parallelism`` fits go on together, so that
    little is lost with a run.
    """
    out: list[SweepRow] = [tuple(row) for row in (known or {}).values()]
    ks = [k for k in range(config.min_k, config.max_k + 1) if k not in (known or {})]
    fits = {
        k: KMeans(k=k, seed=config.seed, featuresCol=features_col, maxIter=config.max_iter, tol=config.tol, solver=SOLVER)
        for k in ks
    }
    at_once = config.parallelism if record else max(1, len(ks))
    own, workers = stack_rows(df, features_col) if blocks is None else blocks, _at_once(df, config.parallelism)

    def done(stopped: dict[int, tuple[np.ndarray, float, int]]) -> None:
        scores = lloyd.silhouettes(own, [c for c, _, _ in stopped.values()])
        for (k, (centres, cost, iterations)), score in zip(stopped.items(), scores, strict=True):
            out.append((k, cost, score, iterations))
            if record:
                record(out[-1], _model(fits[k], centres))

    for i in range(0, len(ks), at_once):
        group = ks[i : i + at_once]
        candidates = _candidates(df, features_col, own, group, fits[group[0]].getInitSteps(), config.seed)
        with ThreadPoolExecutor(max_workers=workers) as pool:
            first = dict(zip(group, pool.map(lambda k: _first_centres(fits[k], candidates[k]), group), strict=True))
        stopped: dict[int, tuple[np.ndarray, float, int]] = {}
        # where nobody waits for a row, all silhouettes share their two passes
        lloyd.converge(own, first, config.max_iter, config.tol, done if record else stopped.update)
        if stopped:
            done(stopped)
    if blocks is None:
        own.unpersist()
    return df.sparkSession.createDataFrame(sorted(out), "k int, wssse double, silhouette double, iterations int")


def choose_k(sweep: DataFrame, config: ChooseConfig = ChooseConfig()) -> DataFrame:
    """k by best silhouette (smallest k on ties), by elbow, and the final k.

    Elbow: the k just before the largest WSSSE drop, i.e. argmin over k of
    wssse(k+1) - wssse(k) (smallest k on ties). Final: the silhouette choice,
    replaced when it is at or below the floor. The sweep has one row per k, so
    the unpartitioned window is bounded by max_k rows.
    """
    by_k = Window.orderBy("k")
    with_drop = sweep.withColumn("drop", F.lead("wssse").over(by_k) - F.col("wssse"))
    # A NaN score (a model whose rows all fell in one cluster) is not eligible;
    # Spark orders NaN above every number, so it is masked to null.
    scored = F.when(~F.isnan("silhouette"), F.struct(F.col("silhouette"), -F.col("k")))
    best = with_drop.agg(
        F.max_by("k", scored).alias("k_silhouette"),
        F.min_by("k", F.when(F.col("drop").isNotNull(), F.struct(F.col("drop"), F.col("k")))).alias("k_elbow"),
    )
    final = F.when(F.col("k_silhouette") <= F.lit(config.floor), F.lit(config.replacement)).otherwise(
        F.col("k_silhouette")
    )
    return best.withColumn("k_final", final.cast("int"))


def centroids(df: DataFrame, features_col: str, label_col: str) -> DataFrame:
    """Mean vector per label as (label, centre array<double>); partial aggregation."""
    vec = as_vector(df, features_col)
    means = df.select(F.col(label_col).alias("label"), vec.alias("v")).groupBy("label").agg(
        Summarizer.mean(F.col("v")).alias("m")
    )
    return means.select("label", vector_to_array("m").alias("centre"))


def model_centres(model: KMeansModel) -> DataFrame:
    """Cluster centres of a fitted model as (cluster, centre array<double>)."""
    spark = model.summary.predictions.sparkSession if model.hasSummary else None
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, centre array<double>")


def collect_centres(centres: DataFrame, id_col: str = "label", centre_col: str = "centre") -> list[tuple[int, list[float]]]:
    """The centres on the driver: they are the parameters of a clustering, not data."""
    return sorted((int(r[0]), [float(x) for x in r[1]]) for r in centres.select(id_col, centre_col).collect())


Centres = Sequence[tuple[int, Sequence[float]]]


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)


def _nearest(vector: Column, centres: Centres) -> Column:
    """The smallest (distance, id) over constant centres."""
    text = json.dumps([{"id": int(i), "c": [float(x) for x in c]} for i, c in centres])
    constant = F.from_json(F.lit(text), "array<struct<id:int,c:array<double>>>")
    return F.array_min(F.transform(constant, lambda c: F.struct(squared_distance(vector, c["c"]).alias("d"), c["id"].alias("id"))))


def assign_nearest(
    df: DataFrame,
    features_col: str,
    centres: Centres,
    prediction_col: str = PREDICTION_COL,
    distance_col: str | None = None,
) -> DataFrame:
    """Label each row with its nearest centre (squared Euclidean; lowest id on
    ties; null for a null vector). A narrow map of array functions: no join, no shuffle, no Python."""
    if not centres:
        raise ValueError("no centres given")
    ordered = sorted(centres)
    chunks = [ordered[i : i + CENTRES_AT_ONCE] for i in range(0, len(ordered), CENTRES_AT_ONCE)]
    # the vector is unpacked once a row: it is the only element of an array that is mapped
    best = F.transform(F.array(as_array(df, features_col)), lambda v: F.when(v.isNotNull(), F.array_min(F.array(*[_nearest(v, c) for c in chunks]))))
    out = df.withColumn("_nearest", best[0]).withColumn(prediction_col, F.col("_nearest.id"))
    if distance_col:
        out = out.withColumn(distance_col, F.col("_nearest.d"))
    return out.drop("_nearest")


def wssse(df: DataFrame, features_col: str, label_col: str, centres: Centres | DataFrame) -> DataFrame:
    """Sum of squared distances of each row to the centre of its own label.
    ``centres``: pairs, or a frame (``label``, ``centre``) of any size. A label without a centre raises
    when the query runs."""
    if not isinstance(centres, DataFrame):
        rows = [(int(i), [float(x) for x in c]) for i, c in centres]
        centres = df.sparkSession.createDataFrame(rows, "label long, centre array<double>")
    own = centres.select(F.col("label").cast("double").alias("label"), "centre")
    rows = df.select(as_array(df, features_col).alias("v"), F.col(label_col).cast("double").alias("label"))
    distances = rows.join(own, "label", "left").select(squared_distance(F.col("v"), F.col("centre")).alias("d"))
    lost = F.count_if(F.col("d").isNull() | F.isnan("d"))
    total = F.when(lost > 0, F.raise_error(F.lit("rows whose label has no centre"))).otherwise(F.sum("d"))
    return distances.agg(total.cast("double").alias("wssse"))
