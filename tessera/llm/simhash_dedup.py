"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Every text gets a 64-bit SimHash of its word shingles (XXH64, seed 42).
2. Texts fall together by fingerprint, so copies cost one row from here on.
3. The 64 bits are dealt into m partitions, correlated bits together, from the
   co-occurrence of bits over all fingerprints.
4. With m partitions and a distance r, a fingerprint may allot r + 1 units among
   its partitions; a partition with t units is probed with every value within
   t - 1 bits of its own. If all partitions differed by at least their units, the
   whole would differ by r + 1 bits or more, so no pair within r is missed.
   The units are allotted for each fingerprint by dynamic programming on the
   candidates it must expect, estimated from histograms of eight-bit blocks.
5. A join of probes and stored values gives candidates; the bit distance of the
   whole fingerprints verifies them.
6. Values shared by more than ``hot_bucket`` fingerprints leave that join. The
   fingerprints that meet there instead write all values within half the
   distance of themselves; two of them are within the distance exactly if they
   write a common one, so they are linked through it, in linear cost.
7. Links between fingerprints become components in rounds of joins.

Defined results: a null text counts as a text without words; a text without
words has fingerprint zero, which is linked like any other; a text with fewer
words than the shingle length has its whole word sequence as one shingle; rows
that repeat share fingerprint and component; a null id is never the smallest of
a component unless all its ids are null (then the component is null). Other
columns of the input are not read, so clashing names do no harm.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, map_batches, pandas_udf, stored

BITS = 64
SEED = 42
BLOCK_BITS = 8
#: Shingles hashed at a time, so a very long text needs bounded arrays.
HASH_SLAB = 1 << 16
#: Most distinct fingerprints with one value of a partition that the join takes.
HOT_BUCKET = 1024
#: Numbers of partitions whose expected cost is compared.
PARTITION_COUNTS = (2, 3, 4)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(octets) < 128:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    counts = np.stack([np.bincount(octets[:, i], minlength=256) for i in range(8)])
    return (counts @ _OCTET_BITS).reshape(BITS)


_OCTET_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit integer."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
        total = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    while slab := [digest(s, SEED) for s in itertools.islice(shingles, HASH_SLAB)]:
        counts += _bit_counts(np.array(slab, np.uint64))
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """SimHash of a text column (bigint)."""

    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return pandas_udf(fingerprint, "long")(text.cast("string"))


def fingerprint_text(fingerprint: Column) -> Column:
    """The fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- partitions of the bits -------------------------------------------------


def _bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlation(fingerprints: DataFrame) -> tuple[int, np.ndarray]:
    """Rows and the 64 x 64 absolute correlation of bits over all fingerprints.
    The cluster sums the co-occurrence counts; 4,096 sums reach the driver."""

    def partial(frames):
        both, seen = np.zeros((BITS, BITS), np.int64), 0
        for frame in frames:
            values = frame["fp"].to_numpy(np.int64)
            for start in range(0, len(values), HASH_SLAB):
                bits = _bit_matrix(np.ascontiguousarray(values[start : start + HASH_SLAB])).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
                seen += len(bits)
        if seen:
            i, j = np.divmod(np.arange(BITS * BITS), BITS)
            yield pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1), "n": np.append(both.ravel(), seen)})

    rows = map_batches(fingerprints.select("fp"), partial, "i long, j long, n long")
    sums = {(r["i"], r["j"]): r["n"] for r in rows.groupBy("i", "j").agg(F.sum("n").alias("n")).collect()}
    total = sums.get((-1, -1), 0)
    both = np.array([[sums.get((i, j), 0) for j in range(BITS)] for i in range(BITS)], float) / max(total, 1)
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return total, np.abs((both - np.outer(mean, mean)) / np.outer(spread, spread))


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits into ``parts`` groups of near-equal size: each group starts
    with the most correlated pair left and takes the bit closest to it."""
    left = set(range(BITS))
    groups = []
    for number in range(parts):
        size = BITS // parts + (number < BITS % parts)
        if size >= len(left):
            group = sorted(left)
        else:
            start = max(itertools.combinations(sorted(left), 2), key=lambda p: correlation[p])
            group = list(start)
            while len(group) < size:
                rest = sorted(left.difference(group))
                group.append(max(rest, key=lambda b: correlation[b, group].sum()))
        left.difference_update(group)
        groups.append(group)
    return groups


def part_values(values: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of a group, packed into one integer for each fingerprint."""
    unsigned = values.view(np.uint64)
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(group):
        out |= ((unsigned >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out.view(np.int64)


def _blocks(group: list[int]) -> list[list[int]]:
    return [group[i : i + BLOCK_BITS] for i in range(0, len(group), BLOCK_BITS)]


def block_histograms(fingerprints: DataFrame, layouts: dict[int, list[list[int]]]) -> dict:
    """Share of each value of each eight-bit block: {(m, part, block): array}.
    The cluster counts; at most 256 numbers for each block reach the driver."""
    names = [(m, p, b, bits) for m, groups in layouts.items() for p, g in enumerate(groups) for b, bits in enumerate(_blocks(g))]

    def partial(frames):
        sums = [np.zeros(1 << BLOCK_BITS, np.int64) for _ in names]
        for frame in frames:
            values = np.ascontiguousarray(frame["fp"].to_numpy(np.int64))
            for k, (_, _, _, bits) in enumerate(names):
                sums[k] += np.bincount(part_values(values, bits), minlength=1 << BLOCK_BITS)
        for k, counts in enumerate(sums):
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"k": np.full(len(at), k), "v": at, "n": counts[at]})

    out = {name[:3]: np.zeros(1 << BLOCK_BITS) for name in names}
    rows = map_batches(fingerprints.select("fp"), partial, "k long, v long, n long")
    for r in rows.groupBy("k", "v").agg(F.sum("n").alias("n")).collect():
        out[names[r["k"]][:3]][r["v"]] = r["n"]
    return {k: v / max(v.sum(), 1) for k, v in out.items()}


_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


class Allotment:
    """Units for each partition of a layout, from estimated candidates."""

    def __init__(self, groups: list[list[int]], shares: list[list[np.ndarray]], rows: int, distance: int):
        self.groups, self.rows, self.distance = groups, rows, distance
        #: for each part and block: share of fingerprints at 0..distance bits from a value
        self.near = [
            [np.stack([(_NEAR == d) @ share for d in range(distance + 1)], axis=1) for share in blocks]
            for blocks in shares
        ]
        self.shares = shares

    def _joined(self, tables: list[np.ndarray]) -> np.ndarray:
        total = tables[0]
        for more in tables[1:]:
            step = np.zeros_like(total)
            for d in range(self.distance + 1):
                for e in range(d + 1):
                    step[:, d] += total[:, e] * more[:, d - e]
            total = step
        return total

    def costs(self, part: int, tables: list[np.ndarray]) -> np.ndarray:
        """Cost of 0 .. distance + 1 units: values probed plus candidates."""
        width = len(self.groups[part])
        probes = np.cumsum([math.comb(width, d) for d in range(self.distance + 1)])
        expected = np.cumsum(self._joined(tables), axis=1) * self.rows
        return np.concatenate([np.zeros((len(expected), 1)), probes[None, :] + expected], axis=1)

    def allot(self, costs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Cheapest way to spend distance + 1 units over the parts, by dynamic
        programming over the parts: (units by part, total cost)."""
        budget, rows = self.distance + 1, len(costs[0])
        best = np.full((rows, budget + 1), np.inf)
        best[:, 0] = 0
        choices = []
        for cost in costs:
            step = np.full_like(best, np.inf)
            choice = np.zeros(best.shape, np.int8)
            for spent in range(budget + 1):
                for units in range(spent + 1):
                    new = best[:, spent - units] + cost[:, units]
                    better = new < step[:, spent]
                    step[better, spent] = new[better]
                    choice[better, spent] = units
            best = step
            choices.append(choice)
        units = np.zeros((rows, len(costs)), np.int8)
        spent = np.full(rows, budget)
        for part in range(len(costs) - 1, -1, -1):
            units[:, part] = choices[part][np.arange(rows), spent]
            spent = spent - units[:, part]
        return units, best[:, budget]

    def for_values(self, values: np.ndarray) -> np.ndarray:
        """Units of every fingerprint for every part."""
        costs = []
        for part, group in enumerate(self.groups):
            tables = [t[part_values(values, bits)] for t, bits in zip(self.near[part], _blocks(group), strict=True)]
            costs.append(self.costs(part, tables))
        return self.allot(costs)[0]

    def expected(self) -> float:
        """Cost of a fingerprint with average candidates, to compare layouts."""
        costs = []
        for part in range(len(self.groups)):
            tables = [(s @ t)[None, :] for s, t in zip(self.shares[part], self.near[part], strict=True)]
            costs.append(self.costs(part, tables))
        return float(self.allot(costs)[1][0]) + len(self.groups)


def fit_allotment(fingerprints: DataFrame, distance: int, parts: tuple[int, ...] = PARTITION_COUNTS) -> Allotment:
    """The layout whose expected cost is lowest, fitted to all fingerprints."""
    rows, correlation = bit_correlation(fingerprints)
    layouts = {m: group_bits(correlation, m) for m in parts}
    shares = block_histograms(fingerprints, layouts)
    fitted = [
        Allotment(groups, [[shares[m, p, b] for b in range(len(_blocks(g)))] for p, g in enumerate(groups)], rows, distance)
        for m, groups in layouts.items()
    ]
    return min(fitted, key=Allotment.expected)


# --- probes, candidates, links ----------------------------------------------


def _masks(width: int, radius: int) -> np.ndarray:
    """All patterns of at most ``radius`` set bits among ``width``."""
    out = [0]
    for r in range(1, radius + 1):
        out += [sum(1 << b for b in bits) for bits in itertools.combinations(range(width), r)]
    return np.array(out, np.uint64).view(np.int64)


def _bucket(part: int, values: np.ndarray) -> np.ndarray:
    """One integer for part and value; values have at most 32 bits or so."""
    return (values << 3) | part


def link_fingerprints(fingerprints: DataFrame, distance: int, hot_bucket: int = HOT_BUCKET, parts: tuple[int, ...] = PARTITION_COUNTS) -> DataFrame:
    """Links ``a``, ``b`` that join exactly what links of at most ``distance``
    bits join. ``fingerprints``: a stored table, one row for each value ``fp``."""
    plan = fit_allotment(fingerprints, distance, parts)
    groups = plan.groups

    def stored_values(frames):
        for frame in frames:
            values = np.ascontiguousarray(frame["fp"].to_numpy(np.int64))
            for part, group in enumerate(groups):
                yield pd.DataFrame({"bucket": _bucket(part, part_values(values, group)), "fp": values})

    def probed_values(frames):
        for frame in frames:
            every = np.ascontiguousarray(frame["fp"].to_numpy(np.int64))
            for start in range(0, len(every), 1024):
                values = np.ascontiguousarray(every[start : start + 1024])
                units = plan.for_values(values)
                for part, group in enumerate(groups):
                    own = part_values(values, group)
                    for spent in range(1, distance + 2):
                        rows = np.flatnonzero(units[:, part] == spent)
                        masks = _masks(len(group), spent - 1)
                        if len(rows):
                            near = (own[rows, None] ^ masks[None, :]).ravel()
                            yield pd.DataFrame({"bucket": _bucket(part, near), "q": np.repeat(values[rows], len(masks))})

    index = stored(map_batches(fingerprints.select("fp"), stored_values, "bucket long, fp long"), "simhash_index")
    probes = stored(map_batches(fingerprints.select("fp"), probed_values, "bucket long, q long"), "simhash_probes")
    hot = stored(index.groupBy("bucket").count().where(F.col("count") > hot_bucket).select("bucket"), "simhash_hot")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance
    verified = (
        probes.join(hot, "bucket", "left_anti")
        .join(index, "bucket")
        .where(near & (F.col("q") != F.col("fp")))
        .select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b"))
        .distinct()
    )
    crowded = (
        index.join(hot, "bucket", "left_semi")
        .select("fp")
        .union(probes.join(hot, "bucket", "left_semi").select("q"))
        .distinct()
    )
    return verified.unionByName(star_links(crowded, distance))


def star_links(fingerprints: DataFrame, distance: int) -> DataFrame:
    """Links through common neighbours: every fingerprint writes all values
    within ceil(distance / 2) bits; those that write one value are linked to the
    smallest of them. Verified, so an odd distance links nothing too far; such a
    value has at most as many writers as it has neighbours."""
    masks = _masks(BITS, (distance + 1) // 2)
    masks = np.unique(masks)

    def neighbours(frames):
        for frame in frames:
            values = frame["fp"].to_numpy(np.int64)
            for start in range(0, len(values), 1024):
                some = values[start : start + 1024]
                yield pd.DataFrame({"z": (some[:, None] ^ masks[None, :]).ravel(), "fp": np.repeat(some, len(masks))})

    written = map_batches(fingerprints.select("fp"), neighbours, "z long, fp long")
    if distance % 2 == 0:
        return (
            written.groupBy("z")
            .agg(F.collect_set("fp").alias("fps"))
            .where(F.size("fps") > 1)
            .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
            .where("a <> b")
            .distinct()
        )
    other = written.select("z", F.col("fp").alias("q"))
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance
    return (
        written.join(other, "z").where(near & (F.col("fp") < F.col("q")))
        .select(F.col("fp").alias("a"), F.col("q").alias("b")).distinct()
    )


def fingerprint_groups(rows: DataFrame, distance: int, hot_bucket: int = HOT_BUCKET, parts: tuple[int, ...] = PARTITION_COUNTS) -> DataFrame:
    """From stored rows (``id``, ``fp``): one row for each fingerprint with
    ``fp``, ``root`` (smallest fingerprint reachable), ``copies`` and
    ``component_id`` (smallest id reachable)."""
    each = stored(
        rows.groupBy("fp").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "simhash_values"
    )
    roots = connected_components(link_fingerprints(each, distance, hot_bucket, parts))
    linked = each.join(roots, each["fp"] == roots["node"], "left").select(
        "fp", "first_id", "copies", F.coalesce("root", "fp").alias("root")
    )
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return stored(linked.join(smallest, "root").select("fp", "root", "copies", "component_id"), "simhash_groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``fingerprint`` (hex),
    ``component_id`` (smallest id reachable) and ``copies`` (rows that share the
    fingerprint). The last join meets hot fingerprints on its larger side only,
    where adaptive execution splits them."""
    rows = stored(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash_rows"
    )
    groups = fingerprint_groups(rows, distance, hot_bucket)
    return rows.join(groups, "fp").select(
        F.col("id").alias("doc_id"), fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id", "copies"
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group left, all
    columns kept: the smallest id's, and one of them if that id repeats."""
    carried = stored(
        docs.select(
            F.struct("*").alias("doc"),
            F.col(id_col).alias("id"),
            fingerprint_column(F.col(text_col), shingle).alias("fp"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "simhash_docs",
    )
    groups = fingerprint_groups(carried.select("id", "fp"), distance)
    first = carried.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "row")).alias("one"))
    chosen = (
        first.join(groups, "fp").groupBy("root").agg(F.min("one").alias("one")).select(F.col("one.row").alias("row"))
    )
    return carried.join(chosen, "row", "left_semi").select("doc.*")
