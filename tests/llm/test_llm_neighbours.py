"""Collision counting against brute force."""

import math

import numpy as np
import pandas as pd
from conftest import SF_SMALL

from tessera.llm import ann_collision as A


def brute(ids, vectors, every, k):
    out = {}
    for q, v in zip(ids, vectors, strict=True):
        if q % every == 0:
            d = np.sqrt(((vectors - v) ** 2).sum(axis=1))
            order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
            out[q] = [(int(ids[i]), d[i]) for i in order]
    return out


def test_recall_and_scores(spark):
    frame = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    pdf = frame.toPandas()
    want = brute(pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"]).astype(float), 20, 10)
    got = A.nearest_neighbours(frame, every=20, block_rows=150, query_rows=10).toPandas()
    hit = total = 0
    for q, rows in want.items():
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        assert mine["score"].is_monotonic_increasing
        truth = dict(rows)
        for v, s in zip(mine["vec_id"], mine["score"], strict=True):
            hit += v in truth
            if v in truth:
                assert abs(s - truth[v]) < 1e-12
        total += len(rows)
    assert hit / total >= 0.95


def test_ties_copies_and_defined_cases(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    rows = [(0, one), (100, one), (7, one), (5, one), (5, one), (3, two), (4, None), (6, []), (8, [0.0, 0.0]), (9, [float("nan"), 1.0]),
            (10, [None, 1.0]), (11, [float("inf"), 0.0]), (12, [1.0, 2.0, 3.0]), (None, one)]
    df = spark.createDataFrame([(i, v, 1.5) for i, v in rows], "vec_id long, embedding array<double>, score double")
    got = [tuple(r) for r in A.nearest_neighbours(df, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 5, 0.0), (0, 2, 7, 0.0), (0, 3, 100, 0.0), (100, 1, 0, 0.0), (100, 2, 5, 0.0), (100, 3, 7, 0.0)]
    few = A.nearest_neighbours(df.where("vec_id in (0, 3)"), k=10).collect()
    assert [(r["query_id"], r["vec_id"]) for r in few] == [(0, 3)]
    assert A.nearest_neighbours(df.limit(0)).count() == 0


def test_threshold_keeps_the_promised_tail():
    rng = np.random.default_rng(1)
    least = A.collision_threshold(96, 2.0, 0.01)
    p = 0.6826894921
    assert (rng.binomial(96, p, 200_000) < least).mean() <= 0.0105
    assert (rng.binomial(96, p, 200_000) < least + 1).mean() > 0.0095


def test_many_copies_of_the_query(spark):
    v = np.tile(np.arange(8.0), (500, 1))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(0, 500), "embedding": v.tolist()}))
    got = A.nearest_neighbours(df, block_rows=64).where("query_id = 100").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(10))


def test_huge_and_tiny_components_end_and_are_exact():
    draw = np.random.default_rng(4)
    for size in (1e308, 1.7e308, 1e200, 1e-200, 5e-324):
        vectors = draw.normal(size=(300, 6))
        with np.errstate(over="ignore"):
            vectors[::50] *= size
        vectors = np.where(vectors == 0, 1.0, np.clip(vectors, -1.7e308, 1.7e308))
        index = A.CollisionIndex(np.arange(300), vectors)
        for own in (0, 50, 7):
            ids, distance = index.nearest(vectors[own], own, 10)
            wanted = [math.dist([float(x) / 4 for x in v], [float(x) / 4 for x in vectors[own]]) * 4 if size > 1 else math.dist(v, vectors[own]) for v in vectors]
            order = sorted((d, i) for i, d in enumerate(wanted) if i != own)[:10]
            assert len(ids) == 10 and np.allclose(distance, [d for d, _ in order], rtol=1e-12)
            if own == 7:
                assert ids.tolist() == [i for _, i in order]


def test_distance_of_tiny_gaps():
    a, b = np.array([[3e-200, 0.0], [0.0, 4e-310], [1e308, -1e308]]), np.array([0.0, 0.0])
    got = A.euclidean(a, b)
    assert np.allclose(got, [3e-200, 4e-310, math.hypot(1e308, 1e308)], rtol=1e-12)
    assert A.euclidean(np.array([[1.7e308, 1.7e308]]), np.array([-1.7e308, -1.7e308]))[0] == np.inf


def clustered(spark, rows, clusters, seed=3, dims=24):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, dims)) * 10
    vectors = centres[np.arange(rows) % clusters] + draw.normal(size=(rows, dims)) * 0.5
    ids = np.arange(rows)
    return ids, vectors, spark.createDataFrame(pd.DataFrame({"id": ids, "vector": vectors.tolist()})).selectExpr("id", "size(vector) dims", "vector")


def test_clusters_are_pruned_without_loss(spark):
    """A query verifies at most a tenth of the rows, and pairs grow more slowly than rows x queries."""
    cost = {}
    for rows in (2_000, 8_000):
        ids, vectors, frame = clustered(spark, rows, rows // 50)
        queries = frame.where("id % 40 = 0").selectExpr("id AS qid", "dims", "vector")
        found = A.search_blocks(queries, frame, 11, block_rows=200).toPandas()
        asked = -(-rows // 40)
        cost[rows] = found["verified"].sum()
        assert cost[rows] <= 0.1 * rows * asked
        got = found[found["vec_id"].notna()].sort_values(["qid", "score", "vec_id"])
        hit = 0
        for q, best in brute(ids, vectors, 40, 10).items():
            mine = set(got[got["qid"] == q]["vec_id"].head(11)) - {q}
            hit += len(mine & {v for v, _ in best})
        assert hit >= 0.98 * 10 * asked
    assert cost[8_000] < 8 * cost[2_000]


def test_stored_index_answers_alike(spark):
    _, vectors, _ = clustered(spark, 300, 5)
    index = A.CollisionIndex(np.arange(300), vectors)
    again = A.CollisionIndex.from_bytes(index.to_bytes())
    for own in (0, 17, 299):
        for one, two in zip(index.nearest(vectors[own], own, 7), again.nearest(vectors[own], own, 7), strict=True):
            assert one.tolist() == two.tolist()


def test_small_blocks_hot_vector_and_odd_lengths_equal_brute_force(spark):
    """A vector that holds a third of the rows, many rings for a pivot, several slices of queries, huge components
    and a length with one row."""
    ids, vectors, _ = clustered(spark, 600, 12, seed=8, dims=6)
    vectors[ids % 3 == 0] = vectors[0]
    vectors[50], vectors[51] = vectors[50] + 1e200, -1.7e308
    frame = pd.DataFrame({"vec_id": ids, "embedding": vectors.tolist()})
    frame.loc[len(frame)] = [1000, [1.0]]
    got = A.nearest_neighbours(spark.createDataFrame(frame), every=5, k=4, block_rows=20, query_rows=3).toPandas()
    assert not (got["query_id"] == 1000).any()
    hit = total = 0
    for q, v in zip(ids[::5], vectors[::5], strict=True):
        distance = A.euclidean(vectors, v)
        best = [int(ids[i]) for i in np.lexsort((ids, distance)) if ids[i] != q][:4]
        mine = got[got["query_id"] == q].sort_values("rank")["vec_id"].tolist()
        if q % 3 == 0:
            assert mine == best
        assert len(mine) == 4
        hit, total = hit + len(set(mine) & set(best)), total + 4
    assert hit >= 0.97 * total
