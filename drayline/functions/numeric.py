"""Arithmetic that tolerates nulls and zero divisors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from drayline.functions._args import as_col, require_list

__all__ = [
    "arithmetic_max",
    "arithmetic_min",
    "exact_mean",
    "exact_sum",
    "not_percent",
    "percent",
    "round_to",
    "safe_add",
    "safe_divide",
    "safe_subtract",
    "to_units",
    "units_mean",
    "units_sum",
    "width_bucket",
]


def round_to(value, places: int = 0) -> Column:
    """Round half away from zero on the binary double (``0.285`` at 2 places is ``0.28``).

    ``F.round`` goes through a decimal string and would give ``0.29``; engines
    that scale, round and unscale the double do not.
    """
    x = as_col(value).cast("double")
    factor = float(10**places)
    return F.signum(x) * F.floor(F.abs(x) * factor + F.lit(0.5)) / F.lit(factor)


def to_units(value, scale: int) -> Column:
    """A number with at most ``scale`` decimals as a whole number of its last decimal."""
    return F.round(as_col(value).cast("double") * float(10**scale)).cast("bigint")


def units_sum(total: Column, scale: int, places: int | None = None) -> Column:
    """A sum of units as a number, optionally rounded to fewer places."""
    if places is None or places >= scale:
        return total / float(10**scale)
    return _round_units(total / float(10 ** (scale - places)), places)


def units_mean(total: Column, count: Column, scale: int, places: int | None = None) -> Column:
    """The mean behind a sum of units and a count, optionally rounded."""
    if places is None:
        return F.try_divide(total.cast("double"), count * F.lit(10**scale))
    if places >= scale:
        return _round_units(F.try_divide((total * 10 ** (places - scale)).cast("double"), count), places)
    return _round_units(F.try_divide(total.cast("double"), count * F.lit(10 ** (scale - places))), places)


def exact_sum(value, scale: int, places: int | None = None) -> Column:
    """Aggregate: sum of a column that holds at most ``scale`` decimals.

    Sums whole units, so the result does not depend on the order in which
    tasks deliver their parts (a sum of doubles does, and rounding then flips
    at ties).
    """
    return units_sum(F.sum(to_units(value, scale)), scale, places)


def exact_mean(value, scale: int, places: int | None = None) -> Column:
    """Aggregate: mean of a column that holds at most ``scale`` decimals, order-independent."""
    units = to_units(value, scale)
    return units_mean(F.sum(units), F.count(units), scale, places)


def _round_units(quotient: Column, places: int) -> Column:
    return F.signum(quotient) * F.floor(F.abs(quotient) + F.lit(0.5)) / F.lit(float(10**places))


def safe_add(fields) -> Column:
    """Sum of the fields, nulls counted as zero."""
    terms = [F.coalesce(as_col(f), F.lit(0)) for f in require_list(fields, "safe_add")]
    return reduce(lambda a, b: a + b, terms)


def safe_subtract(fields) -> Column:
    """First field minus the others, nulls counted as zero."""
    terms = [F.coalesce(as_col(f), F.lit(0)) for f in require_list(fields, "safe_subtract")]
    return reduce(lambda a, b: a - b, terms)


def safe_divide(numerator, denominator) -> Column:
    """Quotient, null when the denominator is zero or either side is null."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def width_bucket(expr, min_value, max_value, num_buckets) -> Column:
    """Equi-width bucket number: 0 below the range, ``num_buckets + 1`` at or above its end."""
    return F.width_bucket(
        as_col(expr).cast("double"),
        as_col(min_value).cast("double"),
        as_col(max_value).cast("double"),
        as_col(num_buckets).cast("int"),
    )


def percent(value, total, places: int = 3) -> Column:
    share = safe_divide(value, total) * F.lit(100.0)
    return round_to(share, places)


def not_percent(value, total, places: int = 3) -> Column:
    share = safe_divide(value, total) * F.lit(100.0)
    return round_to(F.lit(100.0) - share, places)


def arithmetic_min(a, b) -> Column:
    """``(a + b - |a - b|) / 2``: the smaller value, null if either is null."""
    a, b = as_col(a), as_col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def arithmetic_max(a, b) -> Column:
    """The larger value, null if either is null."""
    a, b = as_col(a), as_col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))
