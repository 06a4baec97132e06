"""Column-expression helpers."""

from tessera.functions.exprs import (
    impute,
    is_valid,
    plain_two_decimals,
    qcol,
    to_double,
    two_decimals,
    valid_count,
)

__all__ = ["impute", "is_valid", "plain_two_decimals", "qcol", "to_double", "two_decimals", "valid_count"]
