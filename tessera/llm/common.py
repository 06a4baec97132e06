"""Helpers the operators of this subpackage share.

Row ids, ranks and components are made without ever gathering one group into
one task: ranks come from per-task counters plus a prefix sum over tasks, and
components from rounds of joins whose state lies in the shared folder.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import scratch_path, ship_package, write_shared


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as the bytes of one file, to be opened by :func:`map_arrays`."""
    heads, chunks, at = [], [], 0
    for name, array in arrays.items():
        data = array.tobytes()
        heads.append((name, array.dtype.str, array.shape, at, len(data)))
        chunks.append(data + b"\0" * (-len(data) % 8))
        at += len(chunks[-1])
    return pickle.dumps(heads) + b"".join(chunks)


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file of :func:`pack_arrays`, mapped into memory."""
    with open(path, "rb") as file:
        heads = pickle.load(file)
        base = file.tell()
    whole = np.asarray(np.memmap(path, np.uint8, "r"))
    return {name: whole[base + at : base + at + size].view(kind).reshape(shape) for name, kind, shape, at, size in heads}


def share_files(packed: DataFrame, count: int, name: str) -> list[str]:
    """Have Spark hand files to every executor: one for each ``part`` from 0 to ``count`` - 1 of
    ``packed`` (``part``, ``data``). Tasks make the bytes; the driver passes a few parts on at a time.
    Returns the names to ask ``SparkFiles`` for."""
    names = [""] * count
    for row in stored(packed, name).toLocalIterator():
        address = write_shared(packed.sparkSession, bytes(row["data"]), f"{name}-{row['part']}")
        packed.sparkSession.sparkContext.addFile(address)
        names[row["part"]] = address.rsplit("/", 1)[-1]
    return names


def pandas_udf(function: Callable, returns: str) -> Callable:
    """An Arrow-batched function on columns whose workers have this package."""
    ship_package(SparkSession.active())
    return F.pandas_udf(function, returns)


def map_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInPandas`` whose workers have this package."""
    ship_package(df.sparkSession)
    return df.mapInPandas(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: the
    lineage ends there, so a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partition_id() -> int:
    """Number of the running task's partition (0 outside a task)."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def hash_share(*columns: str) -> Column:
    """A number from 0 to 1 by hash: rows below s are a sample of share s."""
    return F.xxhash64(*columns) / float(1 << 64) + 0.5


def with_rank(df: DataFrame, group: str, part: str, local: str, rank: str) -> DataFrame:
    """Add ``rank``: a gapless number from 0 within each ``group`` value.

    ``df`` is a stored table whose ``part`` is the task that wrote the row and
    ``local`` the row's number within (part, group). Only the (part, group)
    counts are summed up along the parts, so a group that holds most rows costs
    no more than any other: the largest window has one row for each part.
    """
    counts = df.groupBy(part, group).agg((F.max(local) + 1).alias("_rows"))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(part).alias("_part"),
        F.col(group).alias("_group"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    return (
        df.join(starts, (F.col(part) == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
        .withColumn(rank, F.col("_start") + F.col(local))
        .drop("_part", "_group", "_start")
    )


def in_ranges(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``rows`` (a stored table) range-sorted by ``order`` and stored again, with
    ``part`` (number of the range) and ``local`` (row number in it from 0). Rows
    that are equal in ``order`` are parted by their place in the table, so a value
    that holds most rows fills many ranges."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranges = tied.orderBy(*order, "_tie").drop("_tie")
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stored(ranges.withColumn("part", F.spark_partition_id()).withColumn("local", local), "ranges")


def ranked(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``rows`` (a stored table) with ``rank``: a gapless number from 0 by ``order``.
    Only one count a range is summed up in one place."""
    ranges = in_ranges(rows, *order)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.select("part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return ranges.join(starts, "part").withColumn("rank", F.col("_start") + F.col("local")).drop("_start", "part", "local")


def connected_components(links: DataFrame) -> DataFrame:
    """Components of the links (columns ``a``, ``b``): ``node``, ``root`` for
    every node that has a link; ``root`` is the smallest node reachable.

    Alternating large-star and small-star rounds: every node hands its
    neighbours on to the smallest one it knows, until all links are
    (node, root). The number of rounds grows with the logarithm of the longest
    chain. Each round is written to the shared folder; only two numbers a round
    (links and a hash sum) reach the driver.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    state = _edge_state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        )
        edges = stored(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        was, state = state, _edge_state(edges)
        if was == state:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)


def _edge_state(edges: DataFrame) -> tuple:
    one = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(one)).first())
