"""Casts that give null instead of an error, and typed constants."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from drayline.functions._args import as_col
from drayline.functions.temporal import moment

__all__ = [
    "as_of_timestamp",
    "cast_to_timestamp",
    "column_casts_to_timestamp",
    "null_as",
    "safe_cast",
    "type_group",
]


def safe_cast(value, data_type: str) -> Column:
    return as_col(value).try_cast(data_type)


def cast_to_timestamp(value) -> Column:
    """Timestamp from a timestamp, a date or text; text may carry a ``T`` and an offset."""
    column = as_col(value)
    iso = F.try_to_timestamp(column.cast("string"), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"))
    return F.coalesce(column.try_cast("timestamp"), iso)


def null_as(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def as_of_timestamp(as_of=None) -> Column:
    """The given instant, or the current one; pass it wherever results must repeat."""
    return F.current_timestamp() if as_of is None else moment(as_of)


def type_group(data_type: T.DataType) -> str:
    """One of ``numeric``, ``string``, ``boolean``, ``timestamp`` or ``other``."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamp"
    return "other"


def column_casts_to_timestamp(df, column: str) -> bool:
    """Whether some non-null value of the column reads as a timestamp."""
    ok = cast_to_timestamp(F.col(column)).alias("ok")
    return df.where(F.col(column).isNotNull()).select(ok).where(F.col("ok").isNotNull()).limit(1).count() > 0
