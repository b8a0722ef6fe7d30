from __future__ import annotations

from typing import Any

from pyspark.sql import Column, functions as F


def as_col(value: Any) -> Column:
    """Strings name columns, columns pass through, everything else is a literal."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def require_list(fields: Any, function: str) -> list:
    if isinstance(fields, (str, Column, dict)) or not hasattr(fields, "__iter__"):
        raise TypeError(f"{function} takes one list of columns")
    fields = list(fields)
    if not fields:
        raise ValueError(f"{function} needs at least one column")
    return fields
