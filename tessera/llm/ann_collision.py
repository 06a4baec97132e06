"""Nearest neighbours by collision counting over single projections.

1. Equal vectors become one row with the k + 1 smallest of their ids, which is all that any
   answer can show of them; queries with equal vectors are asked once.
2. A hashed sample of vectors, about ``PIVOTS`` times the square root of their number and at most
   ``MAX_PIVOTS``, are pivots, numbered along a chain of neighbours. Each vector belongs to its
   nearest pivot; the rows are range-sorted by pivot and distance to it, and every
   ``block_rows`` in a row are a block: a few pivots' rows, or a ring of one pivot's.
3. Each block keeps, for m random directions, its projections as one sorted array. These
   indexes are built once and stored.
4. A query is first answered in the block that it would itself lie in. The
   distance of the last of its k + 1 nearest there is a bound: by the triangle
   inequality, only blocks with a pivot whose range of distances reaches that near can hold a
   nearer vector, and the query goes to all of these and to no other.
5. In a block, a query opens a window around its own projection in every array. Radius
   after radius (virtual rehashing: the same arrays, wider windows) the windows
   grow; a vector that falls into the windows of at least l directions is verified
   by its exact distance. At radius R the half width is w R / 2, so a vector at
   distance R or less collides in one direction with probability p = 2 Phi(w / 2) - 1
   at least. The search of a block ends at the first radius that is no smaller than the bound or
   its k-th verified distance: every true neighbour then lies within R and is
   missed only if it collided fewer than l times. l is the largest threshold whose
   binomial tail for (m, p) is at most ``miss``, so the expected recall is at least
   1 - miss. There is no cap on candidates.

Pivots and one distance range for each of them are all that the driver and the tasks' closures hold. A
search task holds one block and at most about ``query_rows`` queries. Where vectors lie in clusters most
blocks are never visited; where all distances are much alike (uniform noise in many
dimensions) no bound excludes a block, and the work grows with rows x queries.

Defined results: vectors that are null, empty, zero, or hold nulls or
non-finite numbers take no part, nor do rows without an id; finite numbers may be as large
or small as doubles are (a distance beyond them is infinite). Repeated rows of one
id count once; if an id has several vectors, the smallest in array order stands
for it. Vectors of another length than the query's are no candidates; those of a length
without a pivot are all searched. A query never finds its own id. Ties in distance go to the
smaller id. Fewer candidates than k: all of them. Extra columns are not read.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import hash_share, map_batches, ranked, ship_package, stored

DIRECTIONS = 96
WIDTH = 2.0
GROWTH = 1.2
#: Chance that a true neighbour within the last radius is missed.
MISS = 0.01
SEED = 20240
#: Components up to here can be squared and added as they are.
USUAL = 1e150
BLOCK_ROWS = 8_192
QUERY_ROWS = 4_096
#: Pivots for each unit of the square root of the number of vectors.
PIVOTS = 4
#: Expected number of pivots at most: what tasks are sent is bounded by it.
MAX_PIVOTS = 4_096
#: Queries routed at a time.
_ROUTED = 256


def collision_threshold(directions: int, width: float, miss: float) -> int:
    """Largest l with P(Binomial(directions, p) < l) <= miss."""
    p = 2 * NormalDist().cdf(width / 2) - 1
    below, threshold = 0.0, 0
    while threshold < directions:
        below += math.comb(directions, threshold) * p**threshold * (1 - p) ** (directions - threshold)
        if below > miss:
            break
        threshold += 1
    return max(threshold, 1)


def euclidean(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Distances of rows to a vector (or row by row to as many others); also where squares or differences would leave the range of doubles
    (infinite only if the distance itself does)."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        gap = vectors - query
        out = np.sqrt((gap * gap).sum(axis=1))
        most = np.abs(gap).max(axis=1, initial=0.0)
        odd = np.flatnonzero((most > USUAL) | ((most < 1 / USUAL) & (most > 0)))
        if len(odd):
            huge = most[odd] > USUAL
            moved = np.where(huge[:, None], vectors[odd] / 2 - np.broadcast_to(query, vectors.shape)[odd] / 2, gap[odd] * 2.0**500)
            unit = 2.0 ** np.frexp(np.abs(moved).max(axis=1))[1].clip(-1022, 1023)
            near = moved / unit[:, None]
            out[odd] = np.sqrt((near * near).sum(axis=1)) * unit * np.where(huge, 2.0, 2.0**-500)
    return out


class CollisionIndex:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, directions: int = DIRECTIONS, width: float = WIDTH, miss: float = MISS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        # a power of two that keeps projections finite; 1 for vectors of usual size
        largest = float(np.abs(self.vectors).max()) if len(ids) else 0.0
        self._set(2.0 ** (math.frexp(largest)[1] - 1) if largest > USUAL else 1.0, directions, width, miss)
        projected = (self.vectors / self.scale) @ self.lines
        # one array for all directions: each is moved to a stretch of its own
        self.lift = (np.arange(directions) * (4 * np.abs(projected).max() + 4)) if self.rows else np.zeros(directions)
        self.order = np.argsort(projected, axis=0, kind="stable").T.astype(np.int32)
        self.flat = (np.take_along_axis(projected, self.order.T, axis=0) + self.lift).T.ravel()
        self.order = self.order.ravel()

    def _set(self, scale: float, directions: int, width: float, miss: float) -> None:
        self.scale, self.directions, self.width, self.miss = scale, directions, width, miss
        self.rows = len(self.ids)
        self.lines = np.random.default_rng(SEED).standard_normal((self.vectors.shape[1], directions))
        self.threshold = collision_threshold(directions, width, miss)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors, flat=self.flat, order=self.order, lift=self.lift, given=[self.scale, self.width, self.miss])
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CollisionIndex:
        index = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as kept:
            index.ids, index.vectors, index.flat, index.order, index.lift = (kept[n] for n in ("ids", "vectors", "flat", "order", "lift"))
            scale, width, miss = kept["given"].tolist()
        index._set(scale, len(index.lift), width, miss)
        return index

    def nearest(self, query: np.ndarray, own: int | None, k: int, bound: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact distances of the k nearest found, nearest first."""
        best, distance, _ = self.search(query, k, own, bound)
        return self.ids[best], distance

    def search(self, query: np.ndarray, k: int, own: int | None = None, bound: float = np.inf) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and exact distances of the k nearest found and the number of vectors verified.
        Vectors beyond ``bound`` need not be found."""
        centre = (query / self.scale) @ self.lines + self.lift
        start = np.arange(self.directions) * self.rows
        end = start + self.rows
        middle = np.clip(np.searchsorted(self.flat, centre), start, end)
        low, high = middle.copy(), middle.copy()
        # the first radius opens about k rows in a direction
        ahead = np.abs(self.flat[np.clip(middle + k, start, end - 1)] - centre)
        radius = max(min(2 * float(np.median(ahead)) / self.width, bound / self.scale), 1e-9)
        hits = np.zeros(self.rows, np.int32)
        distance = np.full(self.rows, np.nan)
        others = np.ones(self.rows, bool) if own is None else self.ids != own
        while True:
            half = self.width * radius / 2
            left = np.maximum(np.searchsorted(self.flat, centre - half, "left"), start)
            right = np.minimum(np.searchsorted(self.flat, centre + half, "right"), end)
            left, right = np.minimum(left, low), np.maximum(right, high)
            fresh = [self.order[a:b] for a, b in zip(left, low, strict=True) if a < b]
            fresh += [self.order[a:b] for a, b in zip(high, right, strict=True) if a < b]
            if fresh:
                hits += np.bincount(np.concatenate(fresh), minlength=self.rows).astype(np.int32)
            low, high = left, right
            check = np.flatnonzero((hits >= self.threshold) & np.isnan(distance))
            if len(check):
                distance[check] = euclidean(self.vectors[check], query)
            found = np.flatnonzero(~np.isnan(distance) & others)
            kth = np.partition(distance[found], k - 1)[k - 1] if len(found) >= k else np.inf
            kth = min(kth, bound) / self.scale
            # all windows are open: there is nothing left to find
            if kth <= radius or (np.all(low <= start) and np.all(high >= end)):
                break
            if np.isfinite(kth):
                # no neighbour lies beyond the k-th distance found so far
                radius = min(radius * GROWTH, max(kth, radius * 1.0001))
            else:
                radius *= GROWTH
        best = found[np.lexsort((self.ids[found], distance[found]))[:k]]
        return best, distance[best], int(np.count_nonzero(~np.isnan(distance)))


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One row for each id: ``id``, ``vector`` (doubles), ``dims``."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where(F.col("id").isNotNull() & v.isNotNull())
        .where(finite & F.exists(v, lambda x: x != 0))
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("dims", F.size("vector"))
    )


def _different(rows: DataFrame, keep: int) -> DataFrame:
    """One row for each vector: ``dims``, ``vector`` and ``ids``, its ``keep`` smallest. Each task
    passes on no more than ``keep`` rows of a vector, so copies do not meet in one task."""
    order = Window.partitionBy("dims", "vector").orderBy("id")
    first = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)
    return first.groupBy("dims", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(float)


def _chain(vectors: np.ndarray) -> np.ndarray:
    """Order of the rows in which each is followed by the nearest one that is left."""
    left = np.ones(len(vectors), bool)
    order = [0]
    while len(order) < len(vectors):
        left[order[-1]] = False
        gap = np.where(left, euclidean(vectors, vectors[order[-1]]), np.nan)
        order.append(int(np.nanargmin(gap)))
    return np.array(order)


def _pivots(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length of vectors -> numbers and vectors of its pivots."""
    total = rows.count()
    share = min(math.ceil(PIVOTS * math.sqrt(total)), MAX_PIVOTS) / max(total, 1)
    drawn: dict[int, list] = {}
    for row in rows.where(hash_share("ids") < share).select("dims", "vector").orderBy("dims", "vector").collect():
        drawn.setdefault(row["dims"], []).append(row["vector"])
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dims, vectors in drawn.items():
        centres = np.array(vectors, float)
        out[dims] = np.arange(len(centres), dtype=np.int32), centres[_chain(centres)]
    return out


def _stored_index(rows: DataFrame, pivots: dict, block_rows: int) -> DataFrame:
    """``dims``, ``block``, ``parts`` (``pivot``, ``low``, ``high``: the distances of its rows to the pivot),
    ``members`` (ids of each vector) and the index (``data``) of every block. A length without
    pivots has pivot -1 and distance 0."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for dims, part in frame.groupby("dims", sort=False):
                part = part.assign(pivot=np.int32(-1), gap=0.0)
                if dims in pivots:
                    numbers, centres = pivots[dims]
                    vectors = _matrix(part["vector"])
                    with np.errstate(over="ignore", invalid="ignore"):
                        # the order of squared distances; any pivot would do, so overflow does no harm
                        near = np.argmin(np.nan_to_num((centres * centres).sum(axis=1) - 2 * (vectors @ centres.T)), axis=1)
                    part = part.assign(pivot=numbers[near], gap=euclidean(vectors, centres[near]))
                yield part[["dims", "pivot", "gap", "ids", "vector"]]

    placed = stored(map_batches(rows, assign, "dims int, pivot int, gap double, ids array<long>, vector array<double>"), "ann_placed")
    blocks = ranked(placed, "dims", "pivot", "gap").withColumn("block", F.floor(F.col("rank") / block_rows))

    def build(block: pd.DataFrame) -> pd.DataFrame:
        block = block.assign(id=[ids[0] for ids in block["ids"]]).sort_values("id")
        index = CollisionIndex(block["id"].to_numpy(np.int64), _matrix(block["vector"]))
        gaps = block.groupby("pivot")["gap"].agg(["min", "max"])
        parts = [{"pivot": int(p), "low": low, "high": high} for p, low, high in gaps.itertuples()]
        members = [list(ids) for ids in block["ids"]]
        return pd.DataFrame({"dims": block["dims"].iloc[:1], "block": block["block"].iloc[:1], "parts": [parts], "members": [members], "data": [index.to_bytes()]})

    schema = "dims int, block long, parts array<struct<pivot:int,low:double,high:double>>, members array<array<long>>, data binary"
    return stored(blocks.groupBy("dims", "block").applyInPandas(build, schema), "ann_index")


def _route(queries: DataFrame, pivots: dict, index: DataFrame) -> DataFrame:
    """The blocks (``dims``, ``block``) that each query (``qid``, ``dims``, ``vector``, ``bound``) has to visit: all that
    may hold a vector within the bound; where there is no bound (null), the one it falls in itself."""
    parts = stored(index.select("dims", "block", F.inline("parts")), "ann_parts")
    reached = parts.where("pivot >= 0").groupBy("dims", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    # one row a pivot
    known = {(r["dims"], r["pivot"]): (r["low"], r["high"]) for r in reached.collect()}
    spans = {dims: np.array([known.get((dims, n), (np.inf, -np.inf)) for n in numbers.tolist()]).T for dims, (numbers, _) in pivots.items()}

    def reach(dims: int, vector: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if dims not in pivots:
            far = 0.0 if math.isnan(bound) else np.inf
            return np.array([-1]), np.array([-far]), np.array([far])
        numbers, centres = pivots[dims]
        low, high = spans[dims]
        gap = euclidean(centres, vector)
        if math.isnan(bound):
            nearest = np.argmin(np.where(low <= high, gap, np.inf), keepdims=True)
            return numbers[nearest], gap[nearest], gap[nearest]
        # rounding of the three distances is far below this share of them
        with np.errstate(over="ignore", invalid="ignore"):
            slack = bound + 1e-9 * (bound + gap)
            since = np.where(np.isfinite(gap), gap - slack, -np.inf)
            until = np.where(np.isfinite(gap), gap + slack, np.inf)
        near = np.flatnonzero((high >= since) & (low <= until))
        return numbers[near], since[near], until[near]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), _ROUTED):
                some = frame.iloc[at : at + _ROUTED]
                found = [reach(d, np.asarray(v, float), b) for d, v, b in zip(some["dims"], some["vector"], some["bound"].astype(float), strict=True)]
                some = some[["qid", "dims", "bound"]]
                yield some.assign(pivot=[f[0] for f in found], since=[f[1] for f in found], until=[f[2] for f in found])

    schema = "qid long, dims int, bound double, pivot array<int>, since array<double>, until array<double>"
    spread = map_batches(queries.select("qid", "dims", "vector", "bound"), route, schema)
    spread = spread.select("qid", "dims", "bound", F.inline(F.arrays_zip("pivot", "since", "until")))
    ring = Window.partitionBy("dims", "pivot").orderBy("low", "block")
    rings = parts.select(
        "dims", "pivot", "block", "low", "high",
        F.when(F.row_number().over(ring) == 1, float("-inf")).otherwise(F.col("low")).alias("start"),
        F.coalesce(F.lead("low").over(ring), F.lit(float("inf"))).alias("end"),
    )
    own = F.col("bound").isNull() & (F.col("start") <= F.col("until")) & (F.col("end") > F.col("since"))
    within = F.col("bound").isNotNull() & (F.col("high") >= F.col("since")) & (F.col("low") <= F.col("until"))
    # merged: the routed rows are far larger than the queries that Spark would judge their size by
    pairs = spread.hint("merge").join(rings, ["dims", "pivot"]).where(own | within)
    return pairs.select("qid", "dims", "block").distinct()


def _search(queries: DataFrame, pivots: dict, index: DataFrame, wanted: int, query_rows: int) -> DataFrame:
    """``qid``, ``vec_id``, ``score`` of the ``wanted`` nearest in each block that a query visits, and for each block a row
    with null ``vec_id`` and the number of vectors ``verified``. A block that many queries visit is searched in slices."""
    pairs = stored(_route(queries, pivots, index), "ann_pairs")
    slices = pairs.groupBy("dims", "block").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("slices"))
    asked = pairs.join(slices, ["dims", "block"]).withColumn("slice", F.pmod(F.xxhash64("qid"), "slices"))
    asked = asked.join(queries.select("qid", "vector", "bound"), "qid")
    numbers = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    # merged: the indexes are the large side
    blocks = index.hint("merge").join(slices, ["dims", "block"]).select("dims", "block", "members", "data", F.explode(numbers).alias("slice"))

    def search(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(queries):
            index = CollisionIndex.from_bytes(block["data"].iloc[0])
            members = block["members"].iloc[0]
            for qid, vector, bound in zip(queries["qid"], queries["vector"], queries["bound"].astype(float), strict=True):
                best, distance, verified = index.search(np.asarray(vector, float), wanted, bound=np.inf if math.isnan(bound) else bound)
                near = sorted((d, int(i)) for at, d in zip(best.tolist(), distance.tolist(), strict=True) for i in members[at])[:wanted]
                out.append((qid, None, None, verified))
                out.extend((qid, i, d, None) for d, i in near)
        return pd.DataFrame(out, columns=["qid", "vec_id", "score", "verified"]).astype({"vec_id": "Int64", "verified": "Int64"})

    keys = ["dims", "block", "slice"]
    return blocks.groupBy(*keys).cogroup(asked.select(*keys, "qid", "vector", "bound").groupBy(*keys)).applyInPandas(search, "qid long, vec_id long, score double, verified long")


def search_blocks(queries: DataFrame, vectors: DataFrame, wanted: int, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """For each of ``queries`` (``qid``, ``dims``, ``vector``) the rows of :func:`_search` from every
    block that may hold one of its ``wanted`` nearest among ``vectors`` (``id``, ``dims``, ``vector``)."""
    rows = stored(_different(vectors, wanted), "ann_vectors")
    pivots = _pivots(rows)
    index = _stored_index(rows, pivots, block_rows)
    start = queries.withColumn("bound", F.lit(None).cast("double"))
    near = _search(start, pivots, index, wanted, query_rows).where("vec_id is not null")
    # one block was visited, so a query has no more than ``wanted`` rows
    bounds = near.groupBy("qid").agg(F.get(F.sort_array(F.collect_list("score")), F.lit(wanted - 1)).alias("kth"))
    bounded = queries.join(bounds, "qid", "left").withColumn("bound", F.coalesce("kth", F.lit(float("inf"))))
    return _search(stored(bounded, "ann_bounds"), pivots, index, wanted, query_rows)


def nearest_neighbours(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """For each vector whose id is divisible by ``every``: its k nearest others.
    Columns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (Euclidean)."""
    ship_package(vectors.sparkSession)
    usable = _usable(vectors, id_col, vector_col)
    asked = stored(usable.where(F.col("id") % every == 0), "ann_asked")
    queries = stored(asked.groupBy("dims", "vector").agg(F.min("id").alias("qid")), "ann_queries")
    # a query may find itself, so one more than k
    found = search_blocks(queries, usable, k + 1, block_rows, query_rows).where("vec_id is not null")
    order = Window.partitionBy("qid").orderBy("score", "vec_id")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    best = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
    alike = asked.join(queries, ["dims", "vector"]).select("id", "qid")
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("id")), 1, k)
    answers = alike.join(best, "qid").select(F.col("id").alias("query_id"), F.posexplode(others).alias("place", "one"))
    return answers.select("query_id", (F.col("place") + 1).alias("rank"), "one.vec_id", "one.score")
