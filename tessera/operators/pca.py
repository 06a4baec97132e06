"""Covariance and two-dimensional PCA projection with a fixed sign."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import qcol
from tessera.operators.clustering import as_vector

_VECTOR, _POINT = "_pca_vector", "_pca_point"


def covariance_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample covariance of every pair i <= j, one pass: (col_i, col_j, cov)."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.covar_samp(qcol(a), qcol(b)).alias(f"c{n}") for n, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), F.col(f"c{n}").alias("cov"))
        for n, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.explode(F.array(*cells)).alias("s")).select("s.*")


@dataclass(frozen=True)
class Axes:
    """Fitted principal axes; ``signs`` make each axis' largest loading positive."""

    model: PCAModel
    signs: tuple[float, ...]

    def loadings(self) -> list[list[float]]:
        pc = self.model.pc.toArray()
        return [[float(x) * s for x in pc[:, j]] for j, s in enumerate(self.signs)]


def principal_components(df: DataFrame, features_col: str, k: int = 2) -> Axes:
    """Top-k principal axes (MLlib PCA) with a fixed sign.

    The covariance is a d x d tree aggregate; only that matrix reaches the
    driver.
    """
    data = df.select(as_vector(df, features_col).alias(_VECTOR))
    model = PCA(k=k, inputCol=_VECTOR, outputCol=_POINT).fit(data)
    pc = model.pc.toArray()  # d x k
    signs = tuple(-1.0 if pc[abs(pc[:, j]).argmax(), j] < 0 else 1.0 for j in range(k))
    return Axes(model, signs)


def pca_points(
    df: DataFrame, features_col: str, keep: Sequence[str], k: int = 2, axes: Axes | None = None
) -> DataFrame:
    """Project rows onto the principal axes: (x, y, <kept columns>) for k = 2.

    Uncentred, as MLlib's PCA transform, which does the projection; the result
    stays distributed.
    """
    axes = axes or principal_components(df, features_col, k)
    names = ["x", "y"] if len(axes.signs) == 2 else [f"pc{j + 1}" for j in range(len(axes.signs))]
    projected = axes.model.transform(df.withColumn(_VECTOR, as_vector(df, features_col)))
    point = vector_to_array(F.col(_POINT))
    return projected.select(
        *[(point.getItem(j) * F.lit(s)).alias(n) for j, (n, s) in enumerate(zip(names, axes.signs, strict=True))],
        *[qcol(c) for c in keep],
    )
