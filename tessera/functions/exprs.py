"""Column expressions shared by the operators (all JVM-side, no Python UDF)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    """A top-level column by exact name, safe for dots and hyphens."""
    return F.col(f"`{name}`")


def is_valid(c: Column) -> Column:
    """1 when a measure is present and a number (NaN counts as missing), else 0.

    Infinity and negative values count as valid.
    """
    return F.when(c.isNotNull() & ~F.isnan(c), F.lit(1)).otherwise(F.lit(0))


def valid_count(cols: Sequence[str]) -> Column:
    """Row-wise number of valid measures among ``cols``."""
    if not cols:
        return F.lit(0)
    return reduce(add, [is_valid(qcol(c)) for c in cols])


def impute(c: Column, value: float = 0.0) -> Column:
    """Replace null and NaN by a typed constant."""
    return F.when(c.isNull() | F.isnan(c), F.lit(float(value))).otherwise(c)


def to_double(c: Column) -> Column:
    """Text or number to double; malformed text becomes null (never raises)."""
    return c.try_cast("double")


def two_decimals(c: Column) -> Column:
    """Thousands-grouped, two-decimal display text (``1,234.57``)."""
    return F.format_number(c, 2)


def plain_two_decimals(c: Column) -> Column:
    """Two-decimal text without grouping (``1234.57``); ``to_double`` reads it back."""
    return F.replace(two_decimals(c), F.lit(","), F.lit(""))
