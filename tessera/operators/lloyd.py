"""First candidates, Lloyd's iterations and silhouettes of several clusterings of the same rows, in one pass for all.

The rows are stacked once into blocks of plain doubles, which stay persisted on disk as bytes, so that a pass hands them
to the workers as they are and an executor's heap holds none of them between passes. A pass maps the blocks to one array
of ``centres x (columns + 2)`` numbers for each of a bounded number of tasks (matrix products in numpy, as MLlib's block
solver does them); the driver adds those up in the order of the tasks, as it does MLlib's sums.

The candidates are those of MLlib's k-means||: the same first row, the same draws (``draws.py``) by partition and row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame

from tessera.operators.draws import Draws
from tessera.session import ship_package

#: Bytes of one block at most: well below half a region of a small heap, above which the JVM gives an array regions of its own.
BLOCK_BYTES = 192 << 10
#: Cells of one matrix product (rows x centres), so that its result stays in a core's cache, and rows of it and of a block at most.
CELLS, CHUNK = 1 << 18, 2_048
#: Tasks of a pass at most: so many arrays of a model's size reach the driver, whatever the number of rows.
PARTS = 1_024

Bounds = Sequence[tuple[int, int]]


def stack(df: DataFrame, vector: Column) -> RDD:
    """The vectors (arrays of doubles) as blocks, persisted when they are first read. A vector that is null, of
    another length than its neighbours, or has a value that is not finite raises, as it does in MLlib."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0)
            rows = own.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            width = len(rows) // len(own)
            if own.null_count or not np.isfinite(rows).all() or np.any(own.value_lengths().to_numpy() != width):
                raise ValueError("vectors must not be null, of different lengths or have values that are null, NaN or infinite")
            n = max(1, min(CHUNK, BLOCK_BYTES // max(1, 8 * width))) * max(1, width)
            parts = [rows[i : i + n].tobytes() for i in range(0, len(rows), n)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["block"])

    ship_package(df.sparkSession)
    blocks = df.select(vector.alias("v")).mapInArrow(pack, "block binary")
    return blocks.rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.DISK_ONLY)


def _chunks(blocks: Iterator[bytes], shift: np.ndarray, centres: int) -> Iterator[np.ndarray]:
    """Rows less ``shift``, as columns, above a row of ones and one of their squared lengths."""
    most, width = min(CHUNK, max(1, CELLS // max(1, centres))), len(shift)
    for block in blocks:
        rows = np.frombuffer(block, "<f8").reshape(-1, width)
        for i in range(0, len(rows), most):
            own = rows[i : i + most]
            x = np.empty((width + 2, len(own)))
            np.subtract(own.T, shift[:, None], out=x[:-2])
            x[-2] = 1.0
            np.einsum("ij,ij->j", x[:-2], x[:-2], out=x[-1])
            yield x


def _gaps(centres: np.ndarray, constant: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``constant`` - 2 x centre, by centre and row: squared distances less the rows' own squared length."""
    return np.column_stack([-2.0 * centres, constant]) @ x[:-1]


def _members(gaps: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which centre of each clustering is a row's nearest (the first one on ties), and its gap."""
    hot, least = np.empty(gaps.shape, dtype=bool), []
    for a, b in bounds:
        own, mine = gaps[a:b], hot[a:b]
        least.append(own.min(axis=0))
        np.equal(own, least[-1], out=mine)
        if np.count_nonzero(mine) != own.shape[1]:
            ties = np.flatnonzero(mine.sum(axis=0) != 1)
            mine[:, ties] = False
            mine[own[:, ties].argmin(axis=0), ties] = True
    return hot, least


def _total(blocks: RDD, part: Callable[[Iterator[bytes]], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` over all tasks, in their order."""
    # the blocks keep the partitions of their rows, by which they are drawn
    few = blocks if blocks.getNumPartitions() <= PARTS else blocks.coalesce(PARTS)
    parts = few.mapPartitions(lambda own: [part(own).astype("<f8").tobytes()]).collect()
    return np.sum([np.frombuffer(p, "<f8") for p in parts], axis=0)


def _bounds(centres: Sequence[np.ndarray]) -> list[tuple[int, int]]:
    ends = np.cumsum([len(c) for c in centres]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _near(centres: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    every = np.vstack(centres)
    shift = every.mean(axis=0)
    near = every - shift
    return near, (near * near).sum(axis=1), shift, _bounds(centres)


def assign(blocks: RDD, centres: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """For each clustering, rows going to their nearest centre: the number of rows, sum of rows and sum of
    squared lengths of each cluster (the latter two less the mean of all ``centres``) and the cost."""
    near, constant, shift, bounds = _near(centres)
    shape = (len(near), len(shift) + 2)

    def part(own: Iterator[bytes]) -> np.ndarray:
        sums, costs = np.zeros(shape), np.zeros(len(bounds))
        for x in _chunks(own, shift, len(near)):
            hot, least = _members(_gaps(near, constant, x), bounds)
            sums += hot.astype(float) @ x.T
            costs += [np.maximum(best + x[-1], 0.0).sum() for best in least]
        return np.concatenate([sums.ravel(), costs])

    found = _total(blocks, part)
    sums, costs = found[: shape[0] * shape[1]].reshape(shape), found[shape[0] * shape[1] :]
    return [(sums[a:b, -2], sums[a:b, :-2], sums[a:b, -1], float(cost)) for (a, b), cost in zip(bounds, costs, strict=True)]


def step(blocks: RDD, centres: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """One iteration of each clustering: its new centres (that of an empty cluster stays) and the cost of the old ones."""
    shift, out = np.vstack(centres).mean(axis=0), []
    for old, (rows, sums, _, cost) in zip(centres, assign(blocks, centres), strict=True):
        moved = sums / np.maximum(rows, 1.0)[:, None] + shift
        out.append((np.where(rows[:, None] > 0, moved, old), cost))
    return out


def silhouettes(blocks: RDD, centres: Sequence[np.ndarray]) -> list[float]:
    """Mean silhouette (squared Euclidean, as MLlib defines it) of each clustering's nearest-centre
    clusters: one pass for their sums, one that scores each row by them."""
    near, constant, shift, bounds = _near(centres)
    stats = assign(blocks, centres)
    if any(np.count_nonzero(rows) < 2 for rows, _, _, _ in stats):
        raise ValueError("a silhouette needs a number of clusters greater than one")
    rows = np.concatenate([s[0] for s in stats])
    some = np.maximum(rows, 1.0)
    means = np.vstack([s[1] for s in stats]) / some[:, None]
    # rows have no distance to an empty cluster
    squares = np.where(rows > 0, np.concatenate([s[2] for s in stats]) / some, np.inf)

    def part(own: Iterator[bytes]) -> np.ndarray:
        scores = np.zeros(len(bounds))
        for x in _chunks(own, shift, len(near)):
            hot, _ = _members(_gaps(near, constant, x), bounds)
            mean_gap = _gaps(means, squares, x) + x[-1]
            for i, (a, b) in enumerate(bounds):
                n = np.where(hot[a:b], rows[a:b, None], 0.0).sum(axis=0)
                own = np.where(hot[a:b], mean_gap[a:b], -np.inf).max(axis=0) * n / np.maximum(n - 1.0, 1.0)
                other = np.where(hot[a:b], np.inf, mean_gap[a:b]).min(axis=0)
                larger = np.maximum(own, other)
                score = np.divide(other - own, larger, out=np.zeros(len(own)), where=(larger > 0) & (n > 1))
                scores[i] += score.sum()
        return scores

    return [float(s) / float(st[0].sum()) for s, st in zip(_total(blocks, part), stats, strict=True)]


def candidates(blocks: RDD, first: np.ndarray, ks: Sequence[int], steps: int, seed: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By k: the distinct candidates of MLlib's k-means|| from its ``first`` row, and how many rows are nearest to
    each. A step draws rows with a chance of 2 k times their share of the cost; all k share its two passes."""
    found = {k: first[None, :] for k in ks}
    for number in range(steps):
        # while all have one centre they have one cost
        centres = list(found.values()) if number else [first[None, :]]
        costs = np.broadcast_to(_least_costs(blocks, centres), len(ks))
        chosen = _draw(blocks, centres, [2.0 * k for k in ks], costs, seed ^ (number << 16))
        found = {k: np.vstack([found[k], rows]) for k, rows in zip(ks, chosen, strict=True)}
    # equal rows once, in the order they came
    distinct = {k: np.array(list({row.tobytes(): row for row in rows}.values())) for k, rows in found.items()}
    many = [k for k in ks if len(distinct[k]) > k]
    members = dict(zip(many, _sizes(blocks, [distinct[k] for k in many]), strict=True)) if many else {}
    return {k: (distinct[k], members.get(k, np.ones(len(distinct[k])))) for k in ks}


def _least(gaps: np.ndarray, x: np.ndarray, bounds: Bounds) -> np.ndarray:
    """Squared distances of rows to the nearest centre of each clustering."""
    return np.maximum(np.stack([gaps[a:b].min(axis=0) for a, b in bounds]) + x[-1], 0.0)


def _least_costs(blocks: RDD, centres: Sequence[np.ndarray]) -> np.ndarray:
    near, constant, shift, bounds = _near(centres)

    def part(own: Iterator[bytes]) -> np.ndarray:
        total = np.zeros(len(bounds))
        for x in _chunks(own, shift, len(near)):
            total += _least(_gaps(near, constant, x), x, bounds).sum(axis=1)
        return total

    return _total(blocks, part)


def _draw(
    blocks: RDD, centres: Sequence[np.ndarray], weights: Sequence[float], costs: np.ndarray, seed: int
) -> list[np.ndarray]:
    """By clustering (all of them from one set of centres, or one each): the rows whose draw is below weight x their
    cost / all cost."""
    near, constant, shift, bounds = _near(centres)
    width, factors = len(shift), np.array(weights)[:, None]

    def part(index: int, own: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
        draws = Draws(seed ^ index)
        for block in own:
            rows, at = np.frombuffer(block, "<f8").reshape(-1, width), 0
            for x in _chunks(iter([block]), shift, len(near)):
                least = _least(_gaps(near, constant, x), x, bounds)
                with np.errstate(divide="ignore", invalid="ignore"):
                    hit = draws.take(x.shape[1]) < factors * least / costs[:, None]
                for i, row in zip(*np.nonzero(hit), strict=True):
                    yield int(i), rows[at + row].tobytes()
                at += x.shape[1]

    found: list[list[np.ndarray]] = [[] for _ in weights]
    for i, row in blocks.mapPartitionsWithIndex(part).collect():
        found[i].append(np.frombuffer(row, "<f8"))
    return [np.array(rows).reshape(-1, width) for rows in found]


def _sizes(blocks: RDD, centres: Sequence[np.ndarray]) -> list[np.ndarray]:
    """By clustering: how many rows are nearest to each centre."""
    near, constant, shift, bounds = _near(centres)

    def part(own: Iterator[bytes]) -> np.ndarray:
        sizes = np.zeros(len(near))
        for x in _chunks(own, shift, len(near)):
            sizes += np.count_nonzero(_members(_gaps(near, constant, x), bounds)[0], axis=1)
        return sizes

    sizes = _total(blocks, part)
    return [sizes[a:b] for a, b in bounds]


def converge(
    blocks: RDD,
    centres: dict[int, np.ndarray],
    max_iter: int,
    tol: float,
    done: Callable[[dict[int, tuple[np.ndarray, float, int]]], None],
) -> None:
    """Iterate all clusterings together until each has stopped, as MLlib does: no centre moves by more than
    ``tol``, or ``max_iter`` iterations. ``done`` gets centres, cost and iterations of those that stop, as they stop."""
    live, iteration = dict(centres), 0
    if not max_iter:
        done({key: (c, 0.0, 0) for key, c in live.items()})
        return
    while live:
        moved, iteration = step(blocks, list(live.values())), iteration + 1
        stopped = {}
        for key, (new, cost) in zip(list(live), moved, strict=True):
            still = ((new - live[key]) ** 2).sum(axis=1).max() <= tol * tol
            live[key] = new
            if still or iteration == max_iter:
                stopped[key] = (live.pop(key), cost, iteration)
        if stopped:
            done(stopped)
