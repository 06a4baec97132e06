"""Row-quality operators: flatten, rename, type, complete, flag, filter, impute.

Every operator is DataFrame -> DataFrame and only adds narrow projections or a
filter, so a chain of them collapses into one whole-stage-codegen span next to
the scan (no shuffle, filters and column pruning reach the reader).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import CleanConfig
from tessera.functions.exprs import impute, qcol, to_double, valid_count

VALID_COUNT_COL = "n_valid"


def flatten_struct(
    df: DataFrame, struct_col: str, fields: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Lift ``struct_col.<field>`` to top-level columns named ``<field>``.

    Fields absent from the struct are skipped; ``keep`` columns pass through.
    """
    present = set()
    dtype = df.schema[struct_col].dataType if struct_col in df.columns else None
    if dtype is not None and hasattr(dtype, "names"):
        present = set(dtype.names)
    lifted = [F.col(struct_col).getField(f).alias(f) for f in fields if f in present]
    kept = [qcol(c) for c in keep if c in df.columns]
    return df.select(*kept, *lifted)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names not in the frame are ignored."""
    live = {old: new for old, new in mapping.items() if old in df.columns and old != new}
    return df.withColumnsRenamed(live) if live else df


def cast_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``try_cast`` each present column to double (bad text → null)."""
    live = {c: to_double(qcol(c)) for c in cols if c in df.columns}
    return df.withColumns(live) if live else df


def add_missing_columns(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """Add a typed null column for every name in ``cols`` the frame lacks."""
    missing = {c: F.lit(None).cast(dtype) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def with_valid_count(df: DataFrame, cols: Sequence[str], name: str = VALID_COUNT_COL) -> DataFrame:
    """Append the row-wise number of valid (non-null, non-NaN) measures."""
    return df.withColumn(name, valid_count(cols))


def filter_min_valid(df: DataFrame, cols: Sequence[str], min_valid: int) -> DataFrame:
    """Keep rows with at least ``min_valid`` valid measures (predicate inline)."""
    return df.filter(valid_count(cols) >= F.lit(min_valid))


def impute_columns(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Replace null and NaN with ``value`` in each listed column."""
    return df.withColumns({c: impute(qcol(c), value) for c in cols})


def conform(df: DataFrame, columns: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Complete and order: each (name, type) exists, typed, in this order.

    A type of None keeps a present column as it is (absent ones become string).
    """
    out = []
    for name, dtype in columns:
        if name in df.columns:
            out.append(qcol(name) if dtype is None else qcol(name).cast(dtype).alias(name))
        else:
            out.append(F.lit(None).cast(dtype or "string").alias(name))
    return df.select(*out)


def clean_table(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """The ingest clean step on a flat frame.

    Absent measures become typed nulls, measures are ``try_cast`` to double,
    rows with fewer than ``min_valid`` valid measures are dropped, the rest are
    imputed, and the frame is conformed to descriptive (string) + measure
    (double) columns in fixed order.
    """
    measures = list(config.measure_cols)
    out = add_missing_columns(df, measures, "double")
    out = cast_double(out, measures)
    out = filter_min_valid(out, measures, config.min_valid)
    out = impute_columns(out, measures, config.impute_value)
    schema = [(c, config.descriptive_type) for c in config.descriptive_cols] + [(c, "double") for c in measures]
    return conform(out, schema)
