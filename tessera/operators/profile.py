"""Profiling: counts, quantiles, summary statistics, word count, preview.

Quantiles come in two modes. ``relative_error > 0`` is Spark's Greenwald-Khanna
sketch (``percentile_approx``: one pass, bounded memory, result depends on the
partition layout). ``relative_error == 0`` is exact: the value at 1-based rank
``max(1, ceil(q*n))`` among non-null, non-NaN values, which is SQL
``percentile_disc``.

The exact mode looks first and counts then. One pass makes a KLL sketch of every
column, whose error bound gives a narrow range for each wanted rank. The next pass counts on
the cluster how many values lie below, in ``BINS`` equal bins of, and above each range; the bin that
holds the wanted rank, from its smallest to its largest value, is the next range. Where a range is
expected to hold few values each is counted by itself, which ends it. Values outside
the ranges are counted too, so a sketch that missed only costs another pass. It ends when the value
is known: the bin's smallest or largest, or all its values are equal. The counting is done on Arrow batches
(``bins.py``), each column sorted once a batch. A pass narrows a range by a factor of ``BINS``, so
ties cannot keep it going and no task or driver ever holds values, only counts by bin. Every second pass bins by
order of magnitude, so values of very different size need no more passes than
others. All columns and probabilities share each pass.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import qcol, two_decimals
from tessera.operators import bins
from tessera.session import ship_package

#: Bins of one pass; the driver gets at most this many counts for each quantile.
BINS = 4096


def _valid(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def target_rank(q: float, n: int) -> int:
    """1-based rank of the q-quantile among n values (same double arithmetic as Spark)."""
    return max(1, int(math.ceil(float(q) * float(n))))


#: Natural logarithm of the smallest double is a little above this.
_LEAST_LOG = -745.0


def _magnitude(x: float) -> float:
    """Order-preserving logarithm of either sign; zero stays zero."""
    return math.copysign(math.log(abs(x)) - _LEAST_LOG, x) if x else 0.0


#: Size of the sketches, and the share of all ranks by which one may be wrong (1 in 100 times more).
SKETCH, SKETCH_ERROR = 4096, 0.0015

#: Values a range is expected to hold at most for each of them to be counted by itself.
FEW = 50_000

Ranges = list[tuple[float, float]]


def bracket(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float]) -> dict[str, tuple[int, Ranges]]:
    """By column: number of its values and, for each probability, a range that should
    hold the quantile. One pass."""
    sketches = []
    for i, c in enumerate(cols):
        x = qcol(c).cast("double")
        valid = F.when(_valid(x), x)
        sketches += [F.count(valid).alias(f"n{i}"), F.kll_sketch_agg_double(valid, SKETCH).alias(f"s{i}")]
    sides = [min(max(q + e, 0.0), 1.0) for q in probabilities for e in (-SKETCH_ERROR, SKETCH_ERROR)]
    ranks = F.array(*[F.lit(r) for r in sides])
    found = [F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", ranks)).alias(f"q{i}") for i in range(len(cols))]
    row = df.agg(*sketches).select(*[f"n{i}" for i in range(len(cols))], *found).first()
    return {c: (row[f"n{i}"], list(zip(row[f"q{i}"][::2], row[f"q{i}"][1::2], strict=True)) if row[f"n{i}"] else []) for i, c in enumerate(cols)}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float]]:
    """Exact ``percentile_disc`` values by column; ``[]`` for one without values."""
    cols, probabilities = list(cols), [float(q) for q in probabilities]
    brackets = bracket(df, cols, probabilities)
    values = df.select(*[qcol(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    # (column, probability) -> range; ranks are of the whole column
    open_ranges = {(i, j): r for i, c in enumerate(cols) for j, r in enumerate(brackets[c][1])}
    found: dict[tuple[int, int], float] = {}
    for step in itertools.count():
        if not open_ranges:
            break
        by_magnitude = step % 2 == 1
        ranges: dict[int, Ranges] = {}
        for (i, _), r in open_ranges.items():
            ranges.setdefault(i, []).append(r)
        # so many of the bracketed values are left after earlier passes
        share = 2 * SKETCH_ERROR / BINS**step
        single = {i: len(r) * share * brackets[cols[i]][0] <= FEW for i, r in ranges.items()}
        counted = _count_bins(values, {i: _disjoint(r) for i, r in ranges.items()}, by_magnitude, single)
        for key, was in list(open_ranges.items()):
            rank = target_rank(probabilities[key[1]], brackets[cols[key[0]]][0])
            for n, least, most in counted[key[0]]:
                if rank <= n:
                    break
                rank -= n
            if least == most or rank == 1 or rank == n:
                found[key] = least if rank == 1 else most
            elif (least, most) == was and not by_magnitude:
                # neighbouring doubles that no bin can part: at most a few values
                found[key] = _value_at_rank(values, key[0], least, most, rank)
            open_ranges[key] = (least, most)
        open_ranges = {key: r for key, r in open_ranges.items() if key not in found}
    return {c: [found[i, j] for j in range(len(probabilities)) if (i, j) in found] for i, c in enumerate(cols)}


def _disjoint(ranges: Ranges) -> Ranges:
    """The same values in ranges that do not overlap, in order."""
    out: Ranges = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _count_bins(
    values: DataFrame, ranges: dict[int, Ranges], by_magnitude: bool, single: dict[int, bool] | None = None
) -> dict[int, list[tuple]]:
    """By column: (rows, smallest, largest) of each cell that has rows, in order. Columns of ``single``
    have a cell for each value in a range."""
    cells: dict[int, list[bins.Range]] = {}
    for i, own in ranges.items():
        alone = single and single.get(i)
        cells[i] = [(lo, hi, None if alone else _edges(lo, hi, by_magnitude)) for lo, hi in own]
    ship_package(values.sparkSession)
    columns = values.select(*[f"x{i}" for i in cells])
    rows = columns.mapInArrow(lambda batches: bins.count(batches, cells), bins.SCHEMA)
    counts = rows.groupBy("column", "at", "bin", "value").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    out: dict[int, list[tuple]] = {i: [] for i in ranges}
    for r in sorted(counts.collect(), key=lambda r: (r["column"], r["at"], r["bin"], r["lo"])):
        out[r["column"]].append((r["n"], r["lo"], r["hi"]))
    return out


def _edges(lo: float, hi: float, by_magnitude: bool) -> np.ndarray:
    ends = _magnitude(max(lo, -1.7976931348623157e308)), _magnitude(min(hi, 1.7976931348623157e308))
    return bins.edges(lo, hi, BINS, ends if by_magnitude and ends[0] < ends[1] else None, _LEAST_LOG)


def _value_at_rank(values: DataFrame, i: int, lo: float, hi: float, rank: int) -> float:
    """Value at ``rank`` of a range that bins cannot part (fewer than ``BINS`` values)."""
    x = F.col(f"x{i}")
    counts = values.where(_valid(x) & x.between(F.lit(lo), F.lit(hi))).groupBy(x.alias("x")).count().collect()
    for r in sorted(counts, key=lambda r: r["x"]):
        if rank <= r["count"]:
            return r["x"]
        rank -= r["count"]
    raise AssertionError("rank beyond its range")


def sketch_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], relative_error: float
) -> dict[str, list[float]]:
    """Greenwald-Khanna quantiles of several columns in one aggregate pass.

    SQL ``percentile_approx`` with accuracy ``1 / relative_error`` (partial
    sketches merge map-side; memory per task is O(1 / relative_error)). Null and
    NaN are ignored, as ``DataFrame.approxQuantile`` does. ``[]`` for a column
    without values.
    """
    accuracy = max(1, int(round(1.0 / relative_error)))
    probs = [float(q) for q in probabilities]
    aggs = []
    for i, c in enumerate(cols):
        x = qcol(c).cast("double")
        aggs.append(F.percentile_approx(F.when(_valid(x), x), probs, accuracy).alias(f"q{i}"))
    row = df.agg(*aggs).first()
    return {c: [float(v) for v in row[f"q{i}"]] if row[f"q{i}"] is not None else [] for i, c in enumerate(cols)}


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.0,
) -> dict[str, list[float]]:
    """Quantiles by column: exact when ``relative_error == 0``, else a sketch."""
    if relative_error == 0:
        return exact_quantiles(df, cols, probabilities)
    return sketch_quantiles(df, cols, probabilities, relative_error)


SUMMARY_PROBABILITIES = (0.25, 0.5, 0.75)


def summary_stats(df: DataFrame, cols: Sequence[str], relative_error: float = 0.0) -> DataFrame:
    """count, mean, stddev, min, 25/50/75 %, max per column, one row per column.

    Moments come from one aggregate pass; quartiles from :func:`quantiles`
    (exact by default, Spark's ``summary()`` sketch with ``relative_error>0``).
    """
    cols = list(cols)
    qs = quantiles(df, cols, SUMMARY_PROBABILITIES, relative_error)
    aggs = []
    for i, c in enumerate(cols):
        x = qcol(c).cast("double")
        aggs += [
            F.count(x).alias(f"count{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        q = qs[c] or [None, None, None]
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"count{i}").alias("count"),
                F.col(f"mean{i}").alias("mean"),
                F.col(f"std{i}").alias("stddev"),
                F.col(f"min{i}").alias("min"),
                F.lit(q[0]).cast("double").alias("p25"),
                F.lit(q[1]).cast("double").alias("p50"),
                F.lit(q[2]).cast("double").alias("p75"),
                F.col(f"max{i}").alias("max"),
            )
        )
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def quantile_bounds(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], relative_error: float = 0.0
) -> DataFrame:
    """One row per column: (column, lower, upper) at the two probabilities."""
    lo_p, hi_p = probabilities
    qs = quantiles(df, cols, [lo_p, hi_p], relative_error)
    data = [(c, *(qs[c] or [None, None])) for c in cols]
    return df.sparkSession.createDataFrame(data, "column string, lower double, upper double")


def word_count(df: DataFrame, text_col: str, separator: str = " ") -> DataFrame:
    """Tokens split on one literal separator, empty tokens kept; (word, count).

    Partial aggregation runs map-side, so a very frequent word shuffles one row
    per map task rather than one row per occurrence.
    """
    tokens = df.select(F.explode(F.split(qcol(text_col), re.escape(separator), -1)).alias("word"))
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def distinct_count(df: DataFrame, col: str, name: str = "n_distinct") -> DataFrame:
    return df.agg(F.count_distinct(qcol(col)).alias(name))


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by a total order, so the result does not depend on how
    the table is laid out (each task keeps its own first ``n``)."""
    return df.orderBy(*[qcol(c) for c in order_by]).limit(n)


def format_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace numeric columns by two-decimal, thousands-grouped text."""
    return df.withColumns({c: two_decimals(qcol(c)) for c in cols})
