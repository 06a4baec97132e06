"""Feature preparation: sequential outlier trim, assemble, standardise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import TrimConfig
from tessera.functions.exprs import qcol
from tessera.operators.profile import quantiles

FEATURES_COL = "features"
SCALED_COL = "scaled_features"


def outlier_trim(
    df: DataFrame, cols: Sequence[str], config: TrimConfig = TrimConfig()
) -> tuple[DataFrame, list[tuple[str, float, float]]]:
    """Keep rows inside [q_lo, q_hi] of each feature, feature by feature.

    The bounds of feature j come from the rows that survived features < j
    (the order of ``cols`` matters). One sketch pass and, for exact bounds, one or
    two counting passes per feature; the caller should hand in a persisted or checkpointed frame. Empty input → empty
    output and no bounds. Returns the trimmed frame and the bounds used.
    """
    out = df
    bounds: list[tuple[str, float, float]] = []
    for c in cols:
        got = quantiles(out, [c], config.probabilities, config.relative_error)[c]
        if not got:
            return out, bounds
        lo, hi = float(got[0]), float(got[1])
        bounds.append((c, lo, hi))
        out = out.filter(qcol(c).between(F.lit(lo), F.lit(hi)))
    return out, bounds


def assemble_scale(
    df: DataFrame,
    cols: Sequence[str],
    features_col: str = FEATURES_COL,
    scaled_col: str = SCALED_COL,
    with_mean: bool = True,
    with_std: bool = True,
) -> tuple[DataFrame, PipelineModel]:
    """VectorAssembler + StandardScaler (mean 0, sample std 1; std 0 → 0).

    Fitting is one aggregate pass (partial + merged summaries); transform is a
    narrow map. Returns the transformed frame and the fitted pipeline.
    """
    assembler = VectorAssembler(inputCols=list(cols), outputCol=features_col)
    scaler = StandardScaler(
        inputCol=features_col, outputCol=scaled_col, withMean=with_mean, withStd=with_std
    )
    model = Pipeline(stages=[assembler, scaler]).fit(df)
    return model.transform(df), model


def scaled_columns(df: DataFrame, cols: Sequence[str], scaled_col: str = SCALED_COL, prefix: str = "s_") -> DataFrame:
    """Expose a scaled vector as one double column per feature."""
    arr = vector_to_array(F.col(scaled_col))
    return df.withColumns({f"{prefix}{c}": arr.getItem(i) for i, c in enumerate(cols)})
