import math
import random

import pytest

from tessera.functions import plain_two_decimals, to_double
from tessera.operators import profile


def _disc(values, q):
    vals = sorted(v for v in values if v is not None and not math.isnan(v))
    return vals[max(1, math.ceil(q * len(vals))) - 1]


PROBS = [0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0]


@pytest.mark.parametrize("bins", [profile.BINS, 50])
def test_exact_quantiles_match_brute_force(spark, monkeypatch, bins):
    monkeypatch.setattr(profile, "BINS", bins)
    rng = random.Random(3)
    # Heavy ties: one value holds a third of the rows.
    ties = [rng.choice([5.0] * 3 + [rng.uniform(-100, 100) for _ in range(6)]) for _ in range(3000)]
    wide = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in ties]
    rows = [*zip(ties, wide, strict=True), (None, float("nan")), (float("nan"), None), (float("inf"), float("-inf"))]
    df = spark.createDataFrame(rows, "x double, y double").repartition(5)
    got = profile.exact_quantiles(df, ["x", "y"], PROBS)
    for i, c in enumerate("xy"):
        assert got[c] == [_disc([r[i] for r in rows], q) for q in PROBS]


@pytest.mark.parametrize("values", [
    [1.0] * 1000 + [2.0] * 1000, [7.5] * 50, [float(i % 10) for i in range(3000)], [5e-324, 0.0, 1e-323] * 4,
    [1.7976931348623157e308, -1.7976931348623157e308, 0.0], [1.0, math.nextafter(1.0, 2.0)] * 9,
    [float("inf")] * 3 + [float("-inf")] * 3,
])
@pytest.mark.parametrize("bins", [profile.BINS, 100])
def test_exact_quantiles_end_on_ties_and_neighbours(spark, monkeypatch, values, bins):
    monkeypatch.setattr(profile, "BINS", bins)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert profile.exact_quantiles(df, ["x"], PROBS)["x"] == [_disc(values, q) for q in PROBS]


@pytest.mark.parametrize("gathered", [200_000, 300])
def test_tasks_hand_on_counts_of_cells(monkeypatch, gathered):
    import numpy as np
    import pyarrow as pa

    from tessera.operators import bins

    monkeypatch.setattr(bins, "GATHERED", gathered)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=9_000).round(2), [np.inf, -np.inf, np.nan, 0.0, -0.0] * 20])
    y = rng.choice([1.0, 2.0, 3.5, None], size=len(x))
    ranges = {
        0: [(-1.0, -0.5, bins.edges(-1.0, -0.5, 64, None, 0.0)), (0.0, np.inf, bins.edges(0.0, np.inf, 64, None, 0.0))],
        4: [(2.0, 3.0, None), (3.5, 3.5, None)],
    }
    places = rng.permutation(len(x))
    batches = [pa.RecordBatch.from_arrays([pa.array(x[p]), pa.array(list(y[p]), pa.float64())], ["x0", "x4"]) for p in np.array_split(places, 37)]
    got = [r for b in bins.count(iter(batches), ranges) for r in b.to_pylist()]
    assert len({(r["column"], r["at"], r["bin"], r["value"]) for r in got}) == len(got) < 150
    for i, values in ((0, x[~np.isnan(x)]), (4, np.array([v for v in y if v is not None], float))):
        cells = sorted((r for r in got if r["column"] == i), key=lambda r: (r["at"], r["bin"], r["value"]))
        assert sum(r["n"] for r in cells) == len(values)
        assert all(a["hi"] < b["lo"] for a, b in zip(cells, cells[1:]))
        for r in cells:
            own = values[(values >= r["lo"]) & (values <= r["hi"])]
            assert (len(own), own.min(), own.max()) == (r["n"], r["lo"], r["hi"])
    assert [(r["at"], r["lo"], r["n"]) for r in got if r["column"] == 4] == [
        (at, v, int((y == v).sum())) for at, v in ((0, 1.0), (1, 2.0), (3, 3.5))
    ]
    assert list(bins.count(iter([]), ranges)) == []


def test_counting_makes_no_row_for_each_value(spark, monkeypatch):
    df = spark.range(30_000).selectExpr("rand(1) * 9 AS a", "cast(id % 40 AS double) AS b", "cast(null AS double) AS c", "exp(randn(2) * 40) AS d")
    df = df.repartition(3).cache()
    wanted = {c: [_disc([r[c] for r in df.collect()], q) for q in PROBS] for c in "abd"} | {"c": []}
    plans, kind = [], type(df)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: plans.append(self._jdf.queryExecution().toString()) or collect(self))
    for few in (profile.FEW, 1):
        monkeypatch.setattr(profile, "FEW", few)
        assert profile.exact_quantiles(df, list("abcd"), PROBS) == wanted
    assert plans and not any("explode" in plan for plan in plans)
    df.unpersist()


def test_exact_quantiles_empty(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert profile.exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [], "y": [1.0]}


def test_summary_stats_exact(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(1, 101)], "a double, b double")
    rows = {r["column"]: r for r in profile.summary_stats(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 100 and rows["a"]["min"] == 1.0 and rows["a"]["max"] == 100.0
    assert (rows["a"]["p25"], rows["a"]["p50"], rows["a"]["p75"]) == (25.0, 50.0, 75.0)
    assert rows["a"]["mean"] == pytest.approx(50.5)


def test_word_count_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a  b ",), ("b",)], "text string")
    got = {r["word"]: r["count"] for r in profile.word_count(df, "text").collect()}
    assert got == {"a": 1, "": 2, "b": 2}


def test_reference_smoke_sentence(spark):
    df = spark.createDataFrame([("Testing Spark with a simple WordCount example",)], "text string")
    got = {r["word"]: r["count"] for r in profile.word_count(df, "text").collect()}
    assert got == {w: 1 for w in "Testing Spark with a simple WordCount example".split(" ")}


def test_two_decimals_grouped_and_plain(spark):
    df = spark.createDataFrame([(1234567.125, 2.675, 0.005, -0.001)], "a double, b double, c double, d double")
    row = profile.format_columns(df, ["a", "b", "c", "d"]).first()
    assert tuple(row) == ("1,234,567.12", "2.67", "0.01", "-0.00")
    plain = [plain_two_decimals(df[c]).alias(c) for c in "abcd"]
    texts = df.select(*plain)
    assert tuple(texts.first()) == tuple(f"{v:.2f}" for v in (1234567.125, 2.675, 0.005, -0.001))
    assert tuple(texts.select(*[to_double(texts[c]) for c in "abcd"]).first()) == (1234567.12, 2.67, 0.01, 0.0)


def test_preview_does_not_depend_on_the_layout(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "a int, b int")
    want = sorted((i % 7, i) for i in range(100))[:9]
    for parts in (1, 5, 20):
        assert [tuple(r) for r in profile.preview(df.repartition(parts), 9, ["a", "b"]).collect()] == want


def test_sketch_quantiles_within_error(spark):
    values = [float(i) for i in range(10_000)]
    df = spark.createDataFrame([(v, float("nan") if i % 10 == 0 else v) for i, v in enumerate(values)],
                               "x double, y double")
    got = profile.sketch_quantiles(df, ["x", "y"], [0.02, 0.98], 0.01)
    assert abs(got["x"][0] - 200) <= 100 and abs(got["x"][1] - 9800) <= 100
    assert len(got["y"]) == 2 and not any(math.isnan(v) for v in got["y"])
    assert profile.sketch_quantiles(spark.createDataFrame([], "x double"), ["x"], [0.5], 0.01) == {"x": []}


def test_sketch_summary_matches_spark_summary(spark):
    from conftest import SF_SMALL

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_quantity", "l_extendedprice")
    ours = {r["column"]: r for r in profile.summary_stats(li, li.columns, relative_error=1e-4).collect()}
    theirs = {r["summary"]: r for r in li.summary().collect()}
    for c in li.columns:
        for stat, name in (("25%", "p25"), ("50%", "p50"), ("75%", "p75"), ("min", "min"), ("max", "max")):
            assert float(theirs[stat][c]) == ours[c][name]
        assert float(theirs["count"][c]) == ours[c]["count"]
        assert abs(float(theirs["mean"][c]) - ours[c]["mean"]) < 1e-9 * max(1.0, abs(ours[c]["mean"]))
