import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors

from tessera.config import ChooseConfig, SweepConfig
from tessera.operators import clustering, evaluate, pca

# Sweep captured by the reference run (k, WSSSE, silhouette): golden for the
# choice of k (5 by silhouette, 2 by elbow).
REFERENCE_SWEEP = [
    (2, 869334.69, 0.4415), (3, 698757.63, 0.4586), (4, 611989.37, 0.4852), (5, 544765.15, 0.4859),
    (6, 506938.69, 0.4571), (7, 456712.07, 0.4309), (8, 428902.88, 0.4534), (9, 393898.68, 0.4490),
    (10, 377116.71, 0.4557), (11, 353356.03, 0.4536), (12, 340899.11, 0.4464), (13, 328032.55, 0.4442),
    (14, 307389.66, 0.4723), (15, 298259.65, 0.3988),
]


def _choose(spark, rows):
    df = spark.createDataFrame(rows, "k int, wssse double, silhouette double")
    return clustering.choose_k(df, ChooseConfig()).first().asDict()


def test_choose_k_golden(spark):
    assert _choose(spark, REFERENCE_SWEEP) == {"k_silhouette": 5, "k_elbow": 2, "k_final": 5}


def test_choose_k_ties_and_floor(spark):
    tied = [(2, 10.0, 0.3), (3, 8.0, 0.5), (4, 7.0, 0.5), (5, 6.5, 0.1)]
    assert _choose(spark, tied) == {"k_silhouette": 3, "k_elbow": 2, "k_final": 4}
    low = [(2, 10.0, 0.9), (3, 5.0, 0.1)]
    assert _choose(spark, low)["k_final"] == 4


def _silhouette_brute(x, labels):
    out = []
    for i in range(len(x)):
        own = labels[i]
        d = ((x - x[i]) ** 2).sum(axis=1)
        same = labels == own
        n_own = same.sum()
        if n_own == 1:
            out.append(0.0)
            continue
        a = d[same].sum() / (n_own - 1)
        b = min(d[labels == c].mean() for c in set(labels.tolist()) if c != own)
        out.append(1 - a / b if a < b else (b / a - 1 if a > b else 0.0))
    return float(np.mean(out))


def test_silhouette_matches_pairwise_brute_force_with_singleton_and_sparse_labels(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    labels = np.array([0] * 30 + [7] * 29 + [3])
    df = spark.createDataFrame([(x[i].tolist(), int(labels[i])) for i in range(60)], "v array<double>, c int")
    assert clustering.silhouette(df, "v", "c") == pytest.approx(_silhouette_brute(x, labels), abs=1e-9)
    sizes = {r["c"]: r["count"] for r in evaluate.cluster_sizes(df, "c").collect()}
    assert sizes == {0: 30, 3: 1, 7: 29}


def test_silhouette_one_cluster_raises(spark):
    df = spark.createDataFrame([([1.0, 2.0], 0), ([2.0, 1.0], 0)], "v array<double>, c int")
    with pytest.raises(Exception, match="greater than one"):
        clustering.silhouette(df, "v", "c")


def test_assign_nearest_and_wssse_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    centres = [(i, rng.normal(size=5).tolist()) for i in (4, 1, 9)]
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(200)], "id int, v array<double>")
    got = {r["id"]: r["prediction"] for r in clustering.assign_nearest(df, "v", centres).collect()}
    ids = np.array([c for c, _ in centres])
    cm = np.array([c for _, c in centres])
    d = ((x[:, None, :] - cm[None, :, :]) ** 2).sum(axis=2)
    assert got == {i: int(ids[d[i].argmin()]) for i in range(200)}
    lab = clustering.assign_nearest(df, "v", centres)
    w = clustering.wssse(lab, "v", "prediction", centres).first()[0]
    assert w == pytest.approx(d.min(axis=1).sum(), rel=1e-12)


def test_assign_nearest_tie_goes_to_lowest_id(spark):
    df = spark.createDataFrame([(0, [0.0])], "id int, v array<double>")
    out = clustering.assign_nearest(df, "v", [(5, [1.0]), (2, [-1.0])]).first()
    assert out["prediction"] == 2


def test_kmeans_sweep_and_fit_invariants(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(loc=c, scale=0.2, size=(40, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in pts], ["f"]).cache()
    sweep = clustering.kmeans_sweep(df, "f", SweepConfig(min_k=2, max_k=4, max_iter=20, parallelism=2)).collect()
    assert [r["k"] for r in sweep] == [2, 3, 4]
    assert all(-1 <= r["silhouette"] <= 1 for r in sweep)
    model = clustering.fit_kmeans(df, 3, "f")
    pred = model.transform(df)
    assert sum(r["count"] for r in evaluate.cluster_sizes(pred, "prediction").collect()) == 120
    centres = [(i, list(c)) for i, c in enumerate(model.clusterCenters())]
    nearest = clustering.assign_nearest(pred, "f", centres, prediction_col="check")
    assert nearest.filter("check != prediction").count() == 0
    again = clustering.fit_kmeans(df, 3, "f")
    assert [list(c) for c in again.clusterCenters()] == [list(c) for c in model.clusterCenters()]


def test_minmax_constant_column_is_zero(spark):
    prof = spark.createDataFrame([(0, 1.0, 3.0), (1, 3.0, 3.0)], "p int, x double, y double")
    rows = {r["p"]: r for r in evaluate.minmax_normalise(prof, "p").collect()}
    assert (rows[0]["x"], rows[1]["x"], rows[0]["y"], rows[1]["y"]) == (0.0, 1.0, 0.0, 0.0)


def test_pca_matches_numpy_eigh_up_to_sign(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    x = x - x.mean(axis=0)
    df = spark.createDataFrame([(r.tolist(), 0) for r in x], "v array<double>, c int")
    axes = pca.principal_components(df, "v", 2)
    w, v = np.linalg.eigh(np.cov(x, rowvar=False))
    top = v[:, np.argsort(w)[::-1][:2]]
    loadings = axes.loadings()
    for j in range(2):
        assert min(np.abs(np.array(loadings[j]) - top[:, j]).max(), np.abs(np.array(loadings[j]) + top[:, j]).max()) < 1e-8
        assert max(loadings[j], key=abs) > 0
    pts = pca.pca_points(df, "v", ["c"], axes=axes).collect()
    assert len(pts) == 300
    np.testing.assert_allclose([p["x"] for p in pts], x @ np.array(loadings[0]), atol=1e-9)


def test_covariance_matrix(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(100, 3))
    df = spark.createDataFrame([tuple(r.tolist()) for r in x], "a double, b double, c double")
    cov = {(r["col_i"], r["col_j"]): r["cov"] for r in pca.covariance_matrix(df, ["a", "b", "c"]).collect()}
    ref = np.cov(x, rowvar=False)
    assert len(cov) == 6
    assert cov[("a", "c")] == pytest.approx(ref[0, 2], rel=1e-10)


def test_sweep_equals_single_fits(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(loc=c, scale=0.7, size=(150, 3)) for c in ((0, 0, 0), (4, 4, 0), (0, 4, 4))])
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in pts], ["f"]).repartition(3).cache()
    cfg = SweepConfig(min_k=2, max_k=5, max_iter=15, parallelism=2)
    got = {r["k"]: r for r in clustering.kmeans_sweep(df, "f", cfg).collect()}
    for k in range(2, 6):
        model = KMeans(k=k, seed=cfg.seed, featuresCol="f", maxIter=15).fit(df)
        assert got[k]["iterations"] == model.summary.numIter
        assert got[k]["wssse"] == pytest.approx(model.summary.trainingCost, rel=1e-9)
        assert got[k]["silhouette"] == pytest.approx(clustering.silhouette(model.transform(df), "f"), abs=1e-9)


def test_large_coordinates_keep_their_precision(spark):
    df = spark.createDataFrame([(0, [1e9 + 0.9]), (1, [1e9 + 0.1])], "id int, v array<double>")
    got = clustering.assign_nearest(df, "v", [(0, [1e9]), (1, [1e9 + 1])]).orderBy("id").collect()
    assert [r["prediction"] for r in got] == [1, 0]


def test_label_without_a_centre_raises(spark):
    df = spark.createDataFrame([([1.0], 0), ([2.0], 0), ([3.0], 5)], "v array<double>, c int")
    with pytest.raises(Exception, match="no centre"):
        clustering.wssse(df, "v", "c", [(0, [0.0])]).collect()
    with pytest.raises(Exception, match="no centre"):
        clustering.wssse(df.withColumn("c", df["c"].cast("string").cast("int") * 0 + 0.5), "v", "c", [(0, [0.0])]).collect()


def test_centres_beyond_one_constant(spark, monkeypatch):
    draw = np.random.default_rng(5)
    rows, centres = draw.normal(size=(60, 3)), draw.normal(size=(25, 3))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)] + [(60, None)], "id int, v array<double>")
    pairs = [(int(i), c.tolist()) for i, c in enumerate(centres)] + [(99, centres[4].tolist())]
    wanted = ((rows[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1).tolist() + [None]
    for at_once in (1024, 7, 1):
        monkeypatch.setattr(clustering, "CENTRES_AT_ONCE", at_once)
        near = clustering.assign_nearest(df, "v", pairs, distance_col="d").orderBy("id")
        assert [r["prediction"] for r in near.collect()] == wanted
        assert "Python" not in near._jdf.queryExecution().toString()
    cost = clustering.wssse(near.where("id < 60"), "v", "prediction", pairs)
    assert abs(cost.first()[0] - near.agg({"d": "sum"}).first()[0]) < 1e-9


def test_sweep_skips_known_rows(spark):
    df = spark.createDataFrame([(Vectors.dense([float(i), float(i % 3)]),) for i in range(40)], ["f"])
    config = SweepConfig(min_k=2, max_k=4, max_iter=5)
    fitted = []
    got = clustering.kmeans_sweep(df, "f", config, {3: (3, 1.0, 0.5, 2)}, lambda row, model: fitted.append(row[0]))
    assert sorted(fitted) == [2, 4] and [r["wssse"] for r in got.orderBy("k").collect()][1] == 1.0


def test_one_cluster(spark):
    df = spark.createDataFrame([(1, 0), (2, 7), (3, 7), (4, None)], "id int, c int")
    assert [r["id"] for r in evaluate.one_cluster(df, "c", 7).orderBy("id").collect()] == [2, 3]


def test_choose_k_ignores_nan_scores(spark):
    rows = [(2, 10.0, float("nan")), (3, 8.0, 0.2), (4, 7.5, 0.6), (5, 7.4, 0.1)]
    assert _choose(spark, rows) == {"k_silhouette": 4, "k_elbow": 2, "k_final": 4}


def test_fits_of_a_sweep_share_their_passes(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in rng.normal(size=(300, 3))], ["f"]).repartition(3).cache()
    passes, iterations, step = [], [], clustering.lloyd.step
    monkeypatch.setattr(clustering.lloyd, "step", lambda blocks, centres: passes.append(len(centres)) or step(blocks, centres))
    fit = clustering.KMeans.fit
    monkeypatch.setattr(clustering.KMeans, "fit", lambda self, *a: iterations.append(a[0]) or fit(self, *a))
    got = clustering.kmeans_sweep(df, "f", SweepConfig(min_k=2, max_k=7, max_iter=6)).collect()
    assert len(passes) == max(r["iterations"] for r in got) <= 6 and passes[0] == 6 and len(iterations) == 6
    alone = clustering.kmeans_sweep(df, "f", SweepConfig(min_k=2, max_k=7, max_iter=6, parallelism=1), record=lambda row, model: None)
    for a, b in zip(got, alone.collect(), strict=True):
        assert a["iterations"] == b["iterations"] and a["wssse"] == pytest.approx(b["wssse"], rel=1e-12)


def test_silhouettes_of_ties_single_rows_and_empty_clusters(spark):
    from tessera.operators import lloyd

    x = np.array([[0.0], [2.0], [2.0], [4.0], [9.0], [1e3]]) + 1e6
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(2)
    centres = [np.array([[1.0], [3.0], [1e3]]) + 1e6, np.array([[2.0], [-5e3], [2.0], [9.0]]) + 1e6]
    blocks = clustering.stack_rows(df, "v")
    for c, score, (rows, *_), (moved, _) in zip(
        centres, lloyd.silhouettes(blocks, centres), lloyd.assign(blocks, centres), lloyd.step(blocks, centres), strict=True
    ):
        labels = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert score == pytest.approx(_silhouette_brute(x, labels), abs=1e-9)
        assert rows.tolist() == [(labels == i).sum() for i in range(len(c))]
        wanted = [x[labels == i].mean(axis=0) if (labels == i).any() else c[i] for i in range(len(c))]
        np.testing.assert_allclose(moved, wanted, rtol=1e-12)
    with pytest.raises(ValueError, match="greater than one"):
        lloyd.silhouettes(blocks, [np.array([[0.0], [-1e9]])])
    blocks.unpersist()


def test_fit_equals_mllib_and_its_model_is_stored(spark, tmp_dir):
    from tessera.config import FitConfig
    from tessera.sources import sinks

    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in rng.normal(size=(400, 4))], ["f"]).repartition(4).cache()
    config = FitConfig(max_iter=60, tol=1e-6, init_steps=3)
    model = clustering.fit_kmeans(df, 5, "f", config, "cluster")
    theirs = KMeans(k=5, seed=config.seed, featuresCol="f", maxIter=60, tol=1e-6, initSteps=3).fit(df)
    np.testing.assert_allclose(model.clusterCenters(), theirs.clusterCenters(), atol=1e-9)
    sinks.save_model(model, f"{tmp_dir}/model")
    again = sinks.load_kmeans(f"{tmp_dir}/model")
    assert again.getK() == 5 and again.getPredictionCol() == "cluster" and again.transform(df).columns == ["f", "cluster"]
    assert [list(c) for c in again.clusterCenters()] == [list(c) for c in model.clusterCenters()]


def test_first_centres_at_once_are_no_more_than_fill_the_cores(spark, monkeypatch):
    import threading
    import time

    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in rng.normal(size=(200, 2))], ["f"])
    first, lock, running, most = clustering._first_centres, threading.Lock(), [], []

    def counted(kmeans, rows):
        with lock:
            running.append(1)
            most.append(len(running))
        time.sleep(0.2)
        try:
            return first(kmeans, rows)
        finally:
            with lock:
                running.pop()

    monkeypatch.setattr(clustering, "_first_centres", counted)
    config = SweepConfig(min_k=2, max_k=5, max_iter=2)
    for partitions, at_once in ((4 * spark.sparkContext.defaultParallelism, 1), (2, config.parallelism)):
        most.clear()
        assert clustering.kmeans_sweep(df.repartition(partitions).cache(), "f", config).count() == 4
        assert max(most) == at_once


def test_a_pass_needs_no_query_plan(spark, monkeypatch):
    from pyspark.sql import DataFrame

    df = spark.createDataFrame([([float(i), 1.0],) for i in range(50)], "v array<double>").repartition(3)
    blocks = clustering.stack_rows(df, "v")
    monkeypatch.setattr(DataFrame, "collect", lambda self: pytest.fail("a query of its own"))
    (rows, sums, _, _), = clustering.lloyd.assign(blocks, [np.array([[0.0, 1.0], [49.0, 1.0]])])
    assert rows.tolist() == [25, 25] and blocks.getNumPartitions() == 3 and blocks.is_cached
    blocks.unpersist()


def test_draws_are_those_of_spark(spark):
    from tessera.operators.draws import Draws, next_int

    random = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom
    for seed in (0, 42, -7, -(1 << 31), (1 << 62) + 5):
        assert random(seed).nextInt() == next_int(seed)
        theirs, mine = random(seed), Draws(seed)
        got = np.concatenate([mine.take(n) for n in (0, 1, 700, 2)])
        assert got.tolist() == [theirs.nextDouble() for _ in range(703)]
    # across fillings, by a walk of one step at a time
    from tessera.operators import draws

    x, long = np.array([draws.first_state(9)], np.uint64), Draws(9).take(draws.STEPS * draws.LANES + 3)
    for _ in range(2 * (len(long) - 1)):
        x = draws._next(x)
    x = draws._next(x)
    high = int(x[0]) & (1 << 26) - 1
    assert long[-1] == ((high << 27) + (int(draws._next(x)[0]) & (1 << 27) - 1)) * 2.0**-53


def test_first_centres_are_mllibs_and_its_fit_never_sees_the_rows(spark, monkeypatch):
    from pyspark.sql import DataFrame

    rng = np.random.default_rng(9)
    plain = rng.normal(size=(5_000, 3)) * [1.0, 50.0, 1e-3] + 1e3
    tables = {
        "plain": plain.tolist(),
        "repeated": np.repeat(plain[:7], 30, axis=0).tolist() + [[0.0, -0.0, 0.0], [-0.0, 0.0, 0.0]],
        "equal": [[1.5, 2.5, -3.5]] * 40,
        "one row": [[1.0, 2.0, 3.0]],
    }
    fit, seen = KMeans.fit, []
    for name, rows in tables.items():
        df = spark.createDataFrame([(Vectors.dense(r),) for r in rows], ["f"]).repartition(5).cache()
        df.count()
        blocks = clustering.stack_rows(df, "f")
        for steps in (2, 5) if name == "plain" else (3,):
            ks = [2, 9]
            got = clustering._candidates(df, "f", blocks, ks, steps, 42)
            for k in ks:
                kmeans = KMeans(k=k, seed=42, featuresCol="f", maxIter=0, initSteps=steps)
                theirs = kmeans.fit(df).clusterCenters()
                monkeypatch.setattr(clustering.KMeans, "fit", lambda self, data: seen.append(type(data)) or fit(self, data))
                mine = clustering._first_centres(kmeans, got[k])
                monkeypatch.setattr(clustering.KMeans, "fit", fit)
                assert mine.tolist() == [list(c) for c in theirs], (name, steps, k)
        blocks.unpersist()
        df.unpersist()
    assert seen and not any(issubclass(kind, DataFrame) for kind in seen)


def test_blocks_are_small_lie_on_disk_and_keep_the_order_of_the_rows(spark, monkeypatch):
    x = np.arange(60_000.0).reshape(-1, 3)
    df = spark.createDataFrame([(r,) for r in x.tolist()], "v array<double>").repartition(3).cache()
    wanted = [r[0] for r in df.collect()]
    blocks = clustering.stack_rows(df, "v")
    assert np.vstack([np.frombuffer(b).reshape(-1, 3) for b in blocks.collect()]).tolist() == wanted
    level = blocks.getStorageLevel()
    assert level.useDisk and not level.useMemory
    assert max(blocks.map(len).collect()) <= clustering.lloyd.BLOCK_BYTES
    centres = [x[[0, 7_000]], x[[5, 10_000, 19_999]]]
    whole = clustering.lloyd.assign(blocks, centres)
    # fewer arrays to the driver and smaller products change nothing but the order of sums
    monkeypatch.setattr(clustering.lloyd, "PARTS", 2)
    monkeypatch.setattr(clustering.lloyd, "CELLS", 50)
    for (rows, sums, _, cost), (rows2, sums2, _, cost2) in zip(whole, clustering.lloyd.assign(blocks, centres), strict=True):
        assert rows.tolist() == rows2.tolist() and rows.sum() == 20_000
        np.testing.assert_allclose(sums, sums2, rtol=1e-9)
        assert cost == pytest.approx(cost2, rel=1e-12)
    blocks.unpersist()


def test_vectors_that_mllib_refuses_are_refused(spark):
    good = [[float(i), 1.0] for i in range(20)]
    for bad in (None, [float("nan"), 1.0], [float("inf"), 1.0], [1.0, None], [1.0, 2.0, 3.0]):
        df = spark.createDataFrame([(r,) for r in [*good, bad]], "v array<double>").coalesce(1)
        with pytest.raises(Exception):
            clustering.fit_kmeans(df, 2, "v")
    with pytest.raises(ValueError, match="no rows"):
        clustering.fit_kmeans(spark.createDataFrame([], "v array<double>"), 2, "v")
