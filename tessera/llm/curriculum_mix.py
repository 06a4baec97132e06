"""Mixing sources to target weights by a time-varying curriculum.

1. Every source has a weight schedule over training time 0 to 1: straight lines
   between knots. Its integral is the source's weight.
2. The words to take, ``budget`` times all there are, are shared by weight. A
   source's target stops at ``most`` times its size; what is over is shared again by
   weight among the others until none is above.
3. The documents of a source stand in the order of the MD5 of their id, as often
   as needed one round after another. A copy that starts after c words
   of its source is due when the source's share of the schedule's integral is
   c / target: the integral is inverted (a square root within each straight line),
   which gives the copy's training position. The last copy that a source
   gives is taken in part, so a source gives its target to the word.
4. Documents are range-sorted by position.

Running totals within a source come from range-sorted tables: one sum for each range
and source, summed up along the ranges, and a running sum within a range. A
source that holds most rows fills many ranges; nothing gathers a source.

Everything is DataFrame functions. Defined results: a null text has size 0; a row
of size 0 is kept, takes nothing and has no position; a null source is one source,
the last; null ids stand together in the order; rows that repeat
each have their own place; equal rows in equal order give the same
result however they are stored; an empty table gives no rows. Where every source is
full (``budget`` above ``most``) each gives ``most`` times its size. Extra columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import in_ranges, ranked, stored

#: (time, weight) knots from time 0 to time 1.
Schedule = Sequence[tuple[float, float]]

#: Falling, rising and steady schedules whose integrals are 3, 1 and 2.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 2.0), (1.0, 2.0)))
BUDGET = 1.5
MOST = 2

WORD = "[^\\x20\\x09-\\x0D]+"


def word_size(text: Column) -> Column:
    """Number of words: runs without blanks or the control characters 9 to 13."""
    marks = F.translate(F.regexp_replace(text.cast("string"), WORD, "w"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float, float]]:
    """(start, length, weight at the start, at the end, integral before, integral) of each straight line."""
    out, before = [], 0.0
    for (t, a), (u, b) in zip(schedule, schedule[1:], strict=False):
        if u < t or a < 0 or b < 0:
            raise ValueError("a schedule needs rising times and weights of 0 or more")
        area = (u - t) * (a + b) / 2
        out.append((t, u - t, a, b, before, area))
        before += area
    return out


def integral(schedule: Schedule) -> float:
    return sum(s[-1] for s in segments(schedule))


def time_of(share: Column, schedule: Schedule) -> Column:
    """When ``share`` (0 to 1) of the schedule's integral is reached."""
    wanted, out = share * F.lit(integral(schedule)), F.lit(1.0)
    for start, length, a, b, before, area in reversed(segments(schedule)):
        if area > 0:
            y = F.greatest(wanted - F.lit(before), F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * (b - a) / length) * y, F.lit(0.0)))
            since = F.coalesce(F.try_divide(F.lit(2.0) * y, F.lit(a) + root), F.lit(0.0))
            out = F.when(wanted < F.lit(before + area), F.lit(start) + since).otherwise(out)
    return out


def water_level(sources: DataFrame, budget: float, most: float) -> float:
    """Words for each unit of weight so that all sources together take ``budget``
    times their size; sources stop at ``most`` times theirs. ``sources`` is a stored
    table with ``source_size`` and ``weight``; each round is one sum over it."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        most_words = F.lit(float(most)) * F.col("source_size")
        full = most_words <= F.col("weight") * F.lit(level)
        at_most, weight = sources.agg(F.sum(F.when(full, most_words)), F.sum(F.when(~full, F.col("weight")))).first()
        if not weight:
            return math.inf if total else 0.0
        was, level = level, (budget * total - (at_most or 0.0)) / weight
        if level <= was:
            return level


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule], budget: float, most: float) -> DataFrame:
    """``source_key``, ``source_size``, ``plan`` (number of the schedule, dealt to the sources in
    turn by code point, null last) and ``target`` of every source. ``sizes``: ``source``, ``size``."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = (F.col("rank") % len(schedules)).cast("int")
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    sources = stored(
        ranked(stored(sums, "sources"), F.col("source").asc_nulls_last()).withColumn("plan", plan).withColumn("weight", F.get(weights, plan)),
        "source_weights",
    )
    level = water_level(sources, budget, most)
    most_words = F.lit(float(most)) * F.col("source_size")
    # no level: every source with a weight is full
    share = F.when(F.col("weight") > 0, most_words).otherwise(0.0) if math.isinf(level) else F.least(F.col("weight") * F.lit(level), most_words)
    return sources.select(source_key(F.col("source")).alias("source_key"), "source_size", "plan", share.alias("target"))


def source_key(source: Column) -> Column:
    """A source as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    budget: float = BUDGET,
    most: int = MOST,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """One row for each document, range-sorted by its first training position (those that are not
    taken last): ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``
    (words, repeats counted), ``copies`` (array of ``epoch``, ``position``, ``words``),
    ``position`` (of the first copy)."""
    if not any(integral(s) > 0 for s in schedules):
        raise ValueError("no schedule has a weight")
    source = F.col(source_col).cast("string")
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"), source.alias("source"), source_key(source).alias("source_key"),
            word_size(F.col(text_col)).alias("size"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("draw"),
        ),
        "sizes",
    )
    targets = source_targets(rows, schedules, budget, most)
    ranges = in_ranges(rows, "source_key", "draw", "doc_id", "size")

    earlier = Window.partitionBy("source_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("part", "source_key").agg(F.sum("size").alias("words"))
    starts = sums.select("part", "source_key", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    starts = starts.join(targets, "source_key")
    within = Window.partitionBy("part", "source_key").orderBy("local").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    placed = ranges.join(starts, ["part", "source_key"]).withColumn("start", start)

    whole = F.floor("target").cast("long")

    def copy(epoch: Column) -> Column:
        begins = F.col("start") + epoch * F.col("source_size")
        words = F.least(F.col("size"), F.greatest(whole - begins, F.lit(0).cast("long")))
        share = F.coalesce(F.try_divide(begins.cast("double"), F.col("target")), F.lit(0.0))
        position = F.lit(None).cast("double")
        for number, schedule in enumerate(schedules):
            position = F.when(F.col("plan") == number, time_of(share, schedule)).otherwise(position)
        return F.struct(epoch.cast("int").alias("epoch"), position.alias("position"), words.alias("words"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(math.ceil(most) - 1)), copy), lambda c: c["words"] > 0)
    out = placed.withColumn("copies", copies)
    out = out.withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]))
    out = out.withColumn("position", F.get("copies", F.lit(0))["position"])
    ordered = out.orderBy(F.col("position").asc_nulls_last(), "draw", "doc_id", "part", "local")
    return ordered.select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "position")


def training_order(mixed: DataFrame) -> DataFrame:
    """The copies of :func:`mix` in training order: ``doc_id``, ``source``, ``epoch``,
    ``position``, ``words`` (the copy's first words, all but for a source's last copy)."""
    copies = mixed.select("doc_id", "source", F.explode("copies").alias("c")).select("doc_id", "source", "c.*")
    return copies.orderBy("position", "source", "doc_id", "epoch")
