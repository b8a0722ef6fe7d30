"""Date and time functions. Differences in seconds truncate, they do not count boundaries."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, functions as F

from drayline.functions._args import as_col
from drayline.functions.numeric import round_to

__all__ = [
    "Period",
    "date_add_parts",
    "date_diff_parts",
    "day_of_week",
    "epoch_ms_to_timestamp",
    "hour_of_day",
    "hour_of_week",
    "minutes_between",
    "moment",
    "time_add",
    "time_diff",
    "time_trunc",
    "to_char",
]

UNITS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")

# A month counts as 30 days when periods are converted.
HOURS_PER = {"hour": 1, "day": 24, "week": 7 * 24, "month": 30 * 24}


def _unit(unit: str) -> str:
    name = unit.lower()
    if name not in UNITS:
        raise ValueError(f"unsupported time unit {unit!r}")
    return name


def moment(value) -> Column:
    """A timestamp literal in the session's zone; naive datetimes are taken as they read."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            return F.lit(value)
        return F.to_timestamp(F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")))
    return F.lit(value).cast("timestamp")


def time_add(unit: str, amount, timestamp) -> Column:
    return F.timestamp_add(_unit(unit).upper(), as_col(amount).cast("int"), as_col(timestamp))


def time_diff(unit: str, start, end) -> Column:
    """Whole units elapsed from ``start`` to ``end``."""
    return F.timestamp_diff(_unit(unit).upper(), as_col(start), as_col(end))


def time_trunc(unit: str, timestamp) -> Column:
    return F.date_trunc(_unit(unit), as_col(timestamp))


def date_add_parts(unit: str, amount, date) -> Column:
    """Calendar arithmetic on a date."""
    return time_add(unit, amount, as_col(date).cast("timestamp")).cast("date")


def date_diff_parts(unit: str, start, end) -> Column:
    """Number of unit boundaries crossed, the usual meaning of a date difference."""
    unit = _unit(unit)
    if unit in ("second", "minute", "hour"):
        return time_diff(unit, F.date_trunc(unit, as_col(start)), F.date_trunc(unit, as_col(end)))
    if unit == "day":
        return F.date_diff(as_col(end).cast("date"), as_col(start).cast("date")).cast("bigint")
    return time_diff(unit, F.date_trunc(unit, as_col(start)), F.date_trunc(unit, as_col(end)))


def epoch_ms_to_timestamp(millis) -> Column:
    return F.timestamp_millis(as_col(millis).cast("bigint"))


def minutes_between(start, end, places: int = 1) -> Column:
    """Elapsed whole seconds as minutes, rounded."""
    return round_to(time_diff("second", start, end) / F.lit(60.0), places)


def day_of_week(timestamp) -> Column:
    """English weekday name."""
    return F.date_format(as_col(timestamp), "EEEE")


def hour_of_day(timestamp) -> Column:
    return F.hour(as_col(timestamp)).cast("string")


def hour_of_week(timestamp) -> Column:
    """Weekday name followed by the two-digit hour."""
    return F.date_format(as_col(timestamp), "EEEEHH")


def to_char(timestamp, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(as_col(timestamp), pattern)


@dataclass(frozen=True)
class Period:
    """A length of time in calendar units, e.g. ``Period("day", 2)``."""

    period: str = "day"
    count: int = 1

    def __post_init__(self) -> None:
        if self.period not in HOURS_PER:
            raise ValueError(f"period must be one of {sorted(HOURS_PER)}, got {self.period!r}")
        if not isinstance(self.count, int) or isinstance(self.count, bool):
            raise ValueError(f"count must be an integer, got {self.count!r}")
        if self.count < 0:
            raise ValueError("count cannot be negative")

    def convert(self, unit: str) -> "Period":
        """The same length in another unit, fractions dropped."""
        return Period(unit, int(self.count * HOURS_PER[self.period] / HOURS_PER[unit]))

    @property
    def interval(self) -> str:
        """The length as a Spark interval string."""
        return f"{self.count} {self.period}"
