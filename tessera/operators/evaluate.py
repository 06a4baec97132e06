"""Cluster analysis: profile, sizes, min-max normalised profile, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import plain_two_decimals, qcol, two_decimals

AVG_PREFIX = "avg_"


def cluster_profile(df: DataFrame, cols: Sequence[str], label_col: str) -> DataFrame:
    """Mean of each feature per label, columns ``avg_<feature>``.

    Hash aggregation with a map-side partial step: a label holding a third of
    all rows still shuffles only one partial row per map task.
    """
    return df.groupBy(label_col).agg(*[F.avg(qcol(c)).alias(f"{AVG_PREFIX}{c}") for c in cols])


def cluster_sizes(df: DataFrame, label_col: str) -> DataFrame:
    """(label, count) ordered by label; only labels that occur are listed."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count")).orderBy(label_col)


def one_cluster(df: DataFrame, label_col: str, label) -> DataFrame:
    """The rows of one cluster; labels need not be dense."""
    return df.filter(qcol(label_col) == F.lit(label))


def minmax_normalise(profile: DataFrame, label_col: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Scale each statistic to [0, 1] across the groups; a constant one gives 0.

    The extremes are one aggregate row, read as a scalar subquery: nothing is
    gathered into one task.
    """
    cols = [c for c in profile.columns if c != label_col] if cols is None else list(cols)
    sides = [F.min(qcol(c)).alias(f"lo{i}") for i, c in enumerate(cols)]
    sides += [F.max(qcol(c)).alias(f"hi{i}") for i, c in enumerate(cols)]
    extremes = profile.agg(F.struct(*sides)).scalar()
    out = {}
    for i, c in enumerate(cols):
        x, lo, hi = qcol(c), extremes.getField(f"lo{i}"), extremes.getField(f"hi{i}")
        out[c] = F.when(hi - lo == F.lit(0.0), F.lit(0.0)).otherwise((x - lo) / (hi - lo))
    return profile.withColumns(out)


def format_profile(profile: DataFrame, label_col: str, grouped: bool = True) -> DataFrame:
    """Profile with every statistic as two-decimal text, with thousands grouped
    (``1,234.57``) or plain (``1234.57``)."""
    text = two_decimals if grouped else plain_two_decimals
    return profile.withColumns({c: text(qcol(c)) for c in profile.columns if c != label_col})


def cluster_report(
    predictions: DataFrame,
    label_col: str,
    k: int,
    silhouette: float,
    feature_cols: Sequence[str] = (),
) -> DataFrame:
    """One row per cluster: label, size, k, silhouette and optional feature means.

    Sizes and means come from a single grouped aggregation.
    """
    aggs = [F.count(F.lit(1)).alias("size")] + [
        F.avg(qcol(c)).alias(f"{AVG_PREFIX}{c}") for c in feature_cols
    ]
    out = predictions.groupBy(label_col).agg(*aggs)
    return out.withColumns({"k": F.lit(int(k)), "silhouette": F.lit(float(silhouette))}).select(
        label_col, "size", "k", "silhouette", *[f"{AVG_PREFIX}{c}" for c in feature_cols]
    )
