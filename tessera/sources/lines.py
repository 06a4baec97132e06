"""Lines of text files with their places: numbering, the first N, row caps.

A line's place is its file, the split of the file it was read in (by the byte at which
it starts) and its number within that split. Line counts by split are all that is
summed up in one place: one number for each split, never a line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE, BLOCK, PLACE = "_file", "_block", "_place"
_EARLIER = (Window.unboundedPreceding, -1)


def text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``value`` of every line with its ``_file``, ``_block`` and ``_place``."""
    place = F.monotonically_increasing_id()
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), place.alias(PLACE)
    )


def line_counts(lines: DataFrame) -> DataFrame:
    """``rows`` of each split, its ``first`` place and the lines before it: ``in_file``
    and ``before`` (over all files, which stand in the order of their names)."""
    counts = lines.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("rows"), F.min(PLACE).alias("first"))
    own = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(*_EARLIER)
    every = Window.orderBy(FILE, BLOCK).rowsBetween(*_EARLIER)
    return counts.withColumns(
        {"in_file": F.coalesce(F.sum("rows").over(own), F.lit(0)), "before": F.coalesce(F.sum("rows").over(every), F.lit(0))}
    )


def with_line_numbers(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``rows`` (any of ``lines``, with their places) with ``line`` (in its file) and ``number`` (over all
    files), both from 1, in place of ``_block`` and ``_place``. ``rows`` and ``lines`` must read the same files.
    The counts, one for each split, go to the rows; no row is moved."""
    counts = line_counts(lines).drop("rows")
    within = F.col(PLACE) - F.col("first") + 1
    numbered = rows.join(F.broadcast(counts), [FILE, BLOCK]).withColumns({"line": F.col("in_file") + within, "number": F.col("before") + within})
    return numbered.drop(BLOCK, PLACE, "first", "in_file", "before")


def file_names(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Names of the text files of ``path``, in the order of their addresses."""
    jvm = spark.sparkContext._jvm
    return [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in sorted(spark.read.text(path).inputFiles())]


def first_lines(spark: SparkSession, path: str | Sequence[str], n: int) -> DataFrame:
    """Exactly the first ``n`` lines (all, if fewer) of the files of ``path`` in the order of
    their names, with their places (which give their order; small files share partitions).

    Files are counted one, two, four, ... at a time until they hold ``n`` lines, so what
    lies behind is not read. The lines stay in the splits they were read in: the filter
    compares their places with the place of the last line wanted; nothing is shuffled.
    """
    if n < 0:
        raise ValueError("a number of lines is 0 or more")
    names, taken, found, step = file_names(spark, path), 0, 0, 1
    while found < n and taken < len(names):
        found += spark.read.text(names[taken : taken + step]).count()
        taken, step = taken + step, 2 * step
    lines = text_lines(spark, names[:taken] or names[:1])
    if found < n:
        return lines
    last = line_counts(lines).where((F.col("before") < n) & (F.col("before") + F.col("rows") >= n)).first()
    if last is None:
        return lines.limit(0)
    within = F.col(PLACE) - F.lit(last["first"]) < F.lit(n - last["before"])
    in_last = (F.col(BLOCK) < last[BLOCK]) | ((F.col(BLOCK) == last[BLOCK]) & within)
    return lines.where((F.col(FILE) < last[FILE]) | ((F.col(FILE) == last[FILE]) & in_last))


def row_cap(stored: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) of a stored table, in the partitions it is read in.

    A counting pass gives the rows of each partition; the first partitions are taken whole
    and one in part, by two numbers. ``stored`` must be a plain read of stored files (filters
    and projections may follow): only there are partitions and rows the same in every pass.
    """
    if n < 0:
        raise ValueError("a number of rows is 0 or more")
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored.select(F.struct("*").alias("row"), F.spark_partition_id().alias("part"), local.alias("local"))
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(*_EARLIER)), F.lit(0))
    last = counts.withColumn("before", before).where((F.col("before") < n) & (F.col("before") + F.col("rows") >= n)).first()
    if last is None:
        return stored if n else stored.limit(0)
    cut = (F.col("part") == last["part"]) & (F.col("local") < F.lit(n - last["before"]))
    return placed.where((F.col("part") < last["part"]) | cut).select("row.*")
