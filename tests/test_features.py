import math
import random

import numpy as np

from tessera.config import TrimConfig
from tessera.operators import features


def _disc(vals, q):
    vals = sorted(vals)
    return vals[max(1, math.ceil(q * len(vals))) - 1]


def test_sequential_trim_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.gauss(0, 1), rng.expovariate(1.0), float(rng.randint(0, 20))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    trimmed, bounds = features.outlier_trim(df, ["a", "b", "c"], TrimConfig(relative_error=0.0))
    keep = rows
    for j in range(3):
        lo, hi = _disc([r[j] for r in keep], 0.02), _disc([r[j] for r in keep], 0.98)
        assert bounds[j][1:] == (lo, hi)
        keep = [r for r in keep if lo <= r[j] <= hi]
    assert sorted(map(tuple, trimmed.collect())) == sorted(keep)


def test_trim_never_adds_rows_and_empty_stays_empty(spark):
    empty = spark.createDataFrame([], "a double")
    out, bounds = features.outlier_trim(empty, ["a"], TrimConfig(relative_error=0.0))
    assert out.count() == 0 and bounds == []


def test_scaler_mean_zero_std_one_and_constant_zero(spark):
    rows = [(float(i), 3.0) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, k double")
    scaled, _ = features.assemble_scale(df, ["a", "k"])
    arr = np.array([list(r[0]) for r in scaled.select(features.SCALED_COL).collect()])
    assert abs(arr[:, 0].mean()) < 1e-12 and abs(arr[:, 0].std(ddof=1) - 1) < 1e-12
    assert (arr[:, 1] == 0).all()
