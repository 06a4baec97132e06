"""Counts of values by cell, made by the tasks in Arrow batches.

A column's ranges part its values into cells: below, between and above the ranges each is one cell, a range is bins or a
cell for each value. A batch is sorted, so that every cell is a run of it; a task keeps rows, smallest and largest value
of its cells only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

SCHEMA = "column int, at int, bin int, value double, n long, lo double, hi double"
_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.float64(), pa.float64()]
#: Cells a task gathers before those of the same place are added up.
GATHERED = 200_000

#: A range and the least values of its bins but the first; None for a cell for each value.
Range = tuple[float, float, "np.ndarray | None"]


def edges(lo: float, hi: float, bins: int, magnitude: tuple[float, float] | None, least_log: float) -> np.ndarray:
    """The least values of ``bins`` bins of [lo, hi], equal in width or in order of magnitude (given that of both ends),
    with bins of their own for the infinities."""
    most = np.finfo(float).max
    lo, hi, t = max(lo, -most), min(hi, most), np.arange(1, bins) / bins
    with np.errstate(over="ignore", under="ignore"):
        if magnitude:
            y = magnitude[0] * (1.0 - t) + magnitude[1] * t
            inner = np.sign(y) * np.exp(np.abs(y) + least_log)
        else:
            inner = lo * (1.0 - t) + hi * t
    inner = np.maximum.accumulate(np.clip(inner, lo, hi))
    return np.concatenate([[-most], inner, [np.inf]])


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _cells(values: np.ndarray, ranges: Sequence[Range]) -> Iterator[tuple[np.ndarray, ...]]:
    """(at, bin, value, n, lo, hi) of the cells of sorted values."""
    begin = 0
    for r, (lo, hi, inner) in enumerate(ranges):
        a, b = np.searchsorted(values, lo, "left"), np.searchsorted(values, hi, "right")
        yield from _one(values[begin:a], 2 * r)
        own, begin = values[a:b], b
        if len(own):
            bins = np.zeros(len(own), np.int64) if inner is None else np.searchsorted(inner, own, "right")
            at = _runs(own if inner is None else bins)
            ends = np.append(at[1:], len(own))
            yield (
                np.full(len(at), 2 * r + 1), bins[at], own[at] if inner is None else np.zeros(len(at)),
                ends - at, own[at], own[ends - 1],
            )
    yield from _one(values[begin:], 2 * len(ranges))


def _one(values: np.ndarray, at: int) -> Iterator[tuple[np.ndarray, ...]]:
    if len(values):
        # copies, as a view would keep its whole batch
        yield np.array([at]), np.zeros(1, np.int64), np.zeros(1), np.array([len(values)]), values[:1].copy(), values[-1:].copy()


def _added(cells: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One cell for each place."""
    at, number, value, n, lo, hi = (np.concatenate(c) for c in zip(*cells, strict=True))
    order = np.lexsort((value, number, at))
    at, number, value = at[order], number[order], value[order]
    new = np.zeros(len(at), bool)
    for key in (at, number, value):
        new[1:] |= key[1:] != key[:-1]
    new[0] = True
    runs = np.flatnonzero(new)
    return (
        at[runs], number[runs], value[runs], np.add.reduceat(n[order], runs), np.minimum.reduceat(lo[order], runs),
        np.maximum.reduceat(hi[order], runs),
    )


def count(batches: Iterator[pa.RecordBatch], ranges: dict[int, Sequence[Range]]) -> Iterator[pa.RecordBatch]:
    """The cells of a task: a column of ``batches`` for each entry of ``ranges``, in order. Null and NaN are left out."""
    gathered: dict[int, list[tuple[np.ndarray, ...]]] = {i: [] for i in ranges}
    sizes, limits = dict.fromkeys(ranges, 0), dict.fromkeys(ranges, GATHERED)
    for batch in batches:
        for (i, own), column in zip(ranges.items(), batch.columns, strict=True):
            values = np.sort(column.to_numpy(zero_copy_only=False))
            values = values[: len(values) - np.count_nonzero(np.isnan(values))]
            for cells in _cells(values, own):
                gathered[i].append(cells)
                sizes[i] += len(cells[0])
            if sizes[i] > limits[i] or len(gathered[i]) > GATHERED // 100:
                gathered[i] = [_added(gathered[i])]
                sizes[i] = len(gathered[i][0][0])
                # where the cells themselves are many, they are added up less often
                limits[i] = max(GATHERED, 2 * sizes[i])
    for i, cells in gathered.items():
        if cells:
            found = _added(cells)
            columns = [np.full(len(found[0]), i), *found]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)
