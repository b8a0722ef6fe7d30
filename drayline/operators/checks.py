"""Data-quality checks. Each returns its violations as a DataFrame; empty means passed.

Checks that compare neighbouring rows or whole tables aggregate before they
sort, so neither a table without grouping columns nor one dominating value
ends in a single task (see ``chunking``).
"""

from __future__ import annotations

import json
import operator
import uuid
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal
from functools import reduce
from typing import Any, Callable

from pyspark.sql import Column, DataFrame, functions as F

from drayline.functions import Period, as_of_timestamp, moment, safe_divide, slugify
from drayline.operators.chunking import ROWS_PER_CHUNK, ordered_values
from drayline.operators.reshape import except_both_ways, repeat_rows


def _groups(columns: list[str] | None) -> list[str]:
    return list(columns or [])


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


# --- single columns -----------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return unique_combination_of_columns(df.where(F.col(column).isNotNull()), [column])


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their count; null passes."""
    outside = df.where(~F.col(column).isin(*values))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Listed values that do occur."""
    return df.where(F.col(column).isin(*values)).select(F.col(column).alias("value_field")).distinct()


def accepted_range(
    df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Rows outside the range; null passes."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    value = F.col(column)
    broken = F.lit(False)
    if min_value is not None:
        broken = broken | ~(value >= min_value if inclusive else value > min_value)
    if max_value is not None:
        broken = broken | ~(value <= max_value if inclusive else value < max_value)
    return df.where(broken)


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    value = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.where(value == "")


def expression_is_true(df: DataFrame, expression: Column | str, column: str | None = None) -> DataFrame:
    """Rows for which the expression is false; unknown passes.

    With ``column`` the expression is the rest of a comparison, e.g. ``"> 0"``.
    """
    condition = F.expr(f"{column} {expression}") if column else _expr(expression)
    return df.where(~condition)


def at_least_one(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Groups (or the whole table) without any non-null value."""
    groups = _groups(group_by)
    counted = df.groupBy(*groups).agg(F.count(column).alias("filler_column"))
    return counted.where(F.col("filler_column") == 0)


def not_constant(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Groups whose non-null values are all the same.

    Comparing the extremes decides this with a plain map-side aggregate.
    """
    groups = _groups(group_by)
    spread = df.groupBy(*groups).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    return spread.where(F.col("_low") == F.col("_high")).select(
        *groups, F.lit(1).cast("bigint").alias("filler_column")
    )


def not_null_proportion(
    df: DataFrame,
    column: str,
    at_least: float,
    at_most: float = 1.0,
    group_by: list[str] | None = None,
) -> DataFrame:
    groups = _groups(group_by)
    share = safe_divide(F.count(column), F.count(F.lit(1)))
    shares = df.groupBy(*groups).agg(share.alias("not_null_proportion"))
    value = F.col("not_null_proportion")
    return shares.where((value < at_least) | (value > at_most))


def unique_combination_of_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


# --- time and order --------------------------------------------------------------


def recency(
    df: DataFrame,
    field: str,
    as_of: datetime,
    age: Period,
    ignore_time_component: bool = False,
    group_by: list[str] | None = None,
) -> DataFrame:
    """Groups whose newest value is older than ``age`` before ``as_of``."""
    groups = _groups(group_by)
    kind = "date" if ignore_time_component else df.schema[field].dataType
    limit = (moment(as_of) - F.expr(f"interval {age.interval}")).cast(kind)
    newest = df.groupBy(*groups).agg(F.max(field).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", limit).where(F.col("most_recent") < F.col("threshold"))


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: list[str] | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Values that are not the previous value plus the interval.

    Returns the groups, the value and ``previous_<column>``, one row per
    offending row of the table.
    """
    groups = _groups(group_by)
    previous = f"previous_{slugify(column)}"
    values = ordered_values(df, groups, [column], rows_per_chunk)

    def expected(before: str) -> Column:
        if datepart is None:
            return F.col(before) + interval
        kind = df.schema[column].dataType
        return F.timestamp_add(datepart.upper(), F.lit(interval), F.col(before)).cast(kind)

    first = values.where(F.col(column) != expected("previous")).select(
        *groups, column, F.col("previous").alias(previous)
    )
    # Further rows of a repeated value follow that same value.
    repeats = repeat_rows(values.where(F.col(column) != expected(column)), F.col("n") - 1).select(
        *groups, column, F.col(column).alias(previous)
    )
    return first.unionByName(repeats)


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: str,
    upper_bound: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Ranges that are empty or reversed, or that clash with the next range.

    ``gaps`` is ``allowed``, ``not_allowed`` or ``required``.
    """
    touch: dict[str, Callable[[Column, Column], Column]] = {
        "not_allowed": lambda a, b: a == b,
        "allowed": lambda a, b: a <= b,
        "required": lambda a, b: a < b,
    }
    if gaps not in touch:
        raise ValueError(f"gaps must be one of {sorted(touch)}, got {gaps!r}")
    group = [] if partition_by is None else ["partition_by_col"]
    named = df.select(
        *([F.col(partition_by).alias("partition_by_col")] if partition_by else []),
        F.expr(lower_bound).alias("lower_bound"),
        F.expr(upper_bound).alias("upper_bound"),
    )
    values = ordered_values(named, group, ["lower_bound", "upper_bound"], rows_per_chunk)
    lower, upper, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    columns = [*group, "lower_bound", "upper_bound", "next_lower_bound", "is_last_record"]
    last_copies = values.select(
        *group, "lower_bound", "upper_bound",
        F.col("next").alias("next_lower_bound"), F.col("next").isNull().alias("is_last_record"),
    )
    # Earlier copies of a repeated range are followed by the same range.
    other_copies = repeat_rows(values, F.col("n") - 1).select(
        *group, "lower_bound", "upper_bound", lower.alias("next_lower_bound"), F.lit(False).alias("is_last_record")
    )
    unknown = named.where(lower.isNull()).select(
        *group, "lower_bound", "upper_bound", F.lit(None).cast(named.schema["lower_bound"].dataType).alias("next_lower_bound"),
        F.lit(False).alias("is_last_record"),
    )
    rows = last_copies.unionByName(other_copies).unionByName(unknown).select(*columns)
    has_length = lower <= upper if zero_length_range_allowed else lower < upper
    clear = touch[gaps](upper, following)
    return (
        rows.withColumn("range_is_valid", F.coalesce(has_length, F.lit(False)))
        .withColumn("clear_of_next", F.coalesce(clear, F.when(F.col("is_last_record"), True), F.lit(False)))
        .where(~(F.col("range_is_valid") & F.col("clear_of_next")))
    )


# --- two tables ---------------------------------------------------------------------


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Non-null values without a counterpart in the other table."""
    return relationships_where(df, column, to, field)


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | None = None,
    to_condition: str | None = None,
) -> DataFrame:
    left = df.where(from_condition) if from_condition else df
    right = to.where(to_condition) if to_condition else to
    values = left.where(F.col(column).isNotNull()).select(F.col(column).alias("from_id"))
    return values.join(right.select(F.col(field).alias("from_id")), "from_id", "left_anti")


def equality(
    df: DataFrame, compare: DataFrame, columns: list[str] | None = None, keep_duplicates: bool = False
) -> DataFrame:
    """Rows found in only one of the tables."""
    names = columns or df.columns
    return except_both_ways(df.select(*names), compare.select(*names), keep_duplicates)


def equality_failures(differences: DataFrame) -> DataFrame:
    """Differing rows plus the imbalance between the two sides."""
    a = F.count_if(F.col("which_diff") == "a_minus_b")
    b = F.count_if(F.col("which_diff") == "b_minus_a")
    return differences.agg((F.count(F.lit(1)) + F.abs(a - b)).alias("failures"))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose row counts differ between the tables."""
    a = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    b = to.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    return except_both_ways(a, b)


def _paired_counts(
    df: DataFrame, compare: DataFrame, group_by: list[str], names: tuple[str, str]
) -> DataFrame:
    """Row counts of both tables side by side.

    Group columns appear as ``<name>_a`` and ``<name>_b``; null groups never pair up.
    """
    if not group_by:
        both = df.agg(F.count(F.lit(1)).alias(names[0])).unionByName(
            compare.agg(F.count(F.lit(1)).alias(names[1])), allowMissingColumns=True
        )
        return both.agg(*[F.max(n).alias(n) for n in names])
    a = df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(names[0]))
    b = compare.groupBy(*group_by).agg(F.count(F.lit(1)).alias(names[1]))
    a = a.select(names[0], *[F.col(c).alias(f"{c}_a") for c in group_by])
    b = b.select(names[1], *[F.col(c).alias(f"{c}_b") for c in group_by])
    condition = reduce(lambda x, y: x & y, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by])
    sides = [F.col(f"{c}_{side}") for c in group_by for side in ("a", "b")]
    return a.join(b, condition, "full_outer").select(*sides, *names)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Row counts per group with their difference; the check fails if ``diff_count`` sums above 0."""
    paired = _paired_counts(df, compare, _groups(group_by), ("count_a", "count_b"))
    return paired.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Per group the surplus of rows over the other table, 1 when equal, 0 when fewer."""
    ours, theirs = "count_our_model", "count_comparison_model"
    paired = _paired_counts(df, compare, _groups(group_by), (ours, theirs))
    delta = (
        F.when(F.col(ours) > F.col(theirs), F.col(ours) - F.col(theirs))
        .when(F.col(ours) == F.col(theirs), 1)
        .otherwise(0)
    )
    return paired.withColumn("row_count_delta", delta.cast("bigint"))


# --- JSON, freshness, user tests ------------------------------------------------------


def json_conformance(df: DataFrame, column: str, schema: dict) -> DataFrame:
    """Rows whose JSON text does not meet a schema; null text passes.

    Nested objects and arrays of any depth. Keywords: ``type`` (one or a list),
    ``enum``, ``const``, ``minLength``, ``maxLength``, ``pattern``, ``minimum``,
    ``maximum``, ``exclusiveMinimum``, ``exclusiveMaximum``, ``multipleOf``,
    ``properties``, ``required``, ``additionalProperties``, ``minProperties``,
    ``maxProperties``, ``items``, ``minItems``, ``maxItems``, ``uniqueItems``,
    ``allOf``, ``anyOf``, ``oneOf``, ``not``; others raise. A keyword binds
    values of its own type only, a number without a fraction is an integer, and
    ``enum`` compares type and value.
    """
    value = F.try_parse_json(column)
    valid = F.coalesce(value.isNotNull() & _meets(value, schema), F.lit(False))
    return df.where(F.col(column).isNotNull() & ~valid)


# The JSON schema keywords that carry no constraint.
_NOTES = {"$schema", "$id", "title", "description", "default", "examples", "$comment"}


_EXACT = "decimal(38,18)"


def _exact_literal(number: int | float) -> Column | None:
    """A number as written, ``None`` where the exact type does not hold it."""
    parts = Decimal(str(number)).as_tuple()
    if not isinstance(parts.exponent, int) or parts.exponent < -18 or len(parts.digits) + parts.exponent > 20:
        return None
    return F.lit(format(Decimal(str(number)), "f")).cast(_EXACT)


def _meets(value: Column, schema: dict | bool) -> Column:
    """Whether a variant meets a schema."""
    if isinstance(schema, bool):
        return F.lit(schema)
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    # Exact where 20 digits before the point and 18 after it hold the number; the double decides elsewhere.
    exact = F.try_variant_get(value, "$", _EXACT)
    exact = F.when(exact.cast("double") == number, exact)
    text = F.try_variant_get(value, "$", "string")
    is_a = {
        "string": kind == "STRING",
        "number": kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"),
        "boolean": kind == "BOOLEAN",
        "null": kind == "VOID",
        "object": kind.startswith("OBJECT"),
        "array": kind.startswith("ARRAY"),
    }
    is_a["integer"] = is_a["number"] & F.coalesce(exact % F.lit(1).cast(_EXACT) == 0, number == F.rint(number))

    def against(wanted: int | float, compare: Callable[[Column, Column], Column]) -> Column:
        bound = _exact_literal(wanted)
        plain = compare(number, F.lit(float(wanted)))
        return plain if bound is None else F.coalesce(compare(exact, bound), plain)

    items = F.try_variant_get(value, "$", "array<variant>")
    fields = F.try_variant_get(value, "$", "map<string,variant>")

    def when(type_name: str, condition: Column) -> Column:
        return ~is_a[type_name] | F.coalesce(condition, F.lit(False))

    def equals(wanted) -> Column:
        if wanted is None:
            return is_a["null"]
        if isinstance(wanted, bool):
            return is_a["boolean"] & (F.try_variant_get(value, "$", "boolean") == wanted)
        if isinstance(wanted, (int, float)):
            return is_a["number"] & against(wanted, operator.eq)
        if isinstance(wanted, str):
            return is_a["string"] & (text == wanted)
        same = F.to_json(F.parse_json(F.lit(json.dumps(wanted))))
        return (is_a["object"] | is_a["array"]) & (F.to_json(value) == same)

    def member(name: str) -> Column:
        return F.element_at(fields, name)

    every = lambda parts: reduce(lambda a, b: a & b, parts, F.lit(True))
    some = lambda parts: reduce(lambda a, b: a | b, parts, F.lit(False))
    found: list[Column] = []
    for word, bound in schema.items():
        if word == "type":
            names = bound if isinstance(bound, list) else [bound]
            unknown = [n for n in names if n not in is_a]
            if unknown:
                raise ValueError(f"unsupported JSON type {unknown[0]!r}")
            found.append(some(is_a[n] for n in names))
        elif word == "enum":
            found.append(some(equals(v) for v in bound))
        elif word == "const":
            found.append(equals(bound))
        elif word == "minLength":
            found.append(when("string", F.length(text) >= bound))
        elif word == "maxLength":
            found.append(when("string", F.length(text) <= bound))
        elif word == "pattern":
            found.append(when("string", text.rlike(bound)))
        elif word == "minimum":
            found.append(when("number", against(bound, operator.ge)))
        elif word == "maximum":
            found.append(when("number", against(bound, operator.le)))
        elif word == "exclusiveMinimum":
            found.append(when("number", against(bound, operator.gt)))
        elif word == "exclusiveMaximum":
            found.append(when("number", against(bound, operator.lt)))
        elif word == "multipleOf":
            share, step = number / F.lit(float(bound)), _exact_literal(bound)
            near = F.abs(share - F.round(share)) <= 1e-9 * F.greatest(F.abs(share), F.lit(1.0))
            found.append(when("number", near if step is None else F.coalesce(exact % step == 0, near)))
        elif word == "properties":
            found.append(when("object", every(member(n).isNull() | _meets(member(n), sub) for n, sub in bound.items())))
        elif word == "required":
            found.append(when("object", every(member(n).isNotNull() for n in bound)))
        elif word == "additionalProperties":
            named = F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>")
            others = F.map_values(F.map_filter(fields, lambda k, _: ~F.array_contains(named, k)))
            found.append(when("object", F.forall(others, lambda v: F.coalesce(_meets(v, bound), F.lit(False)))))  # noqa: B023
        elif word == "minProperties":
            found.append(when("object", F.size(fields) >= bound))
        elif word == "maxProperties":
            found.append(when("object", F.size(fields) <= bound))
        elif word == "items":
            found.append(when("array", F.forall(items, lambda v: F.coalesce(_meets(v, bound), F.lit(False)))))  # noqa: B023
        elif word == "minItems":
            found.append(when("array", F.size(items) >= bound))
        elif word == "maxItems":
            found.append(when("array", F.size(items) <= bound))
        elif word == "uniqueItems":
            if bound:
                found.append(when("array", F.size(F.array_distinct(F.transform(items, lambda v: F.to_json(v)))) == F.size(items)))
        elif word == "allOf":
            found.append(every(_meets(value, sub) for sub in bound))
        elif word == "anyOf":
            found.append(some(F.coalesce(_meets(value, sub), F.lit(False)) for sub in bound))
        elif word == "oneOf":
            hits = sum((F.coalesce(_meets(value, sub), F.lit(False)).cast("int") for sub in bound), F.lit(0))
            found.append(hits == 1)
        elif word == "not":
            found.append(~F.coalesce(_meets(value, bound), F.lit(False)))
        elif word not in _NOTES:
            raise ValueError(f"unsupported JSON schema keyword {word!r}")
    return every(found)


def source_freshness(
    df: DataFrame,
    loaded_at: Column | str,
    as_of: datetime,
    warn_after: Period | None = None,
    error_after: Period | None = None,
    where: str | None = None,
    name: str = "source",
) -> DataFrame:
    """One row: newest load, its age in seconds and ``pass``, ``warn`` or ``error``."""
    rows = df.where(where) if where else df
    newest = rows.agg(F.max(_expr(loaded_at).cast("timestamp")).alias("max_loaded_at"))
    now = moment(as_of)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now).cast("double")
    status = F.lit("pass")
    for label, limit in (("warn", warn_after), ("error", error_after)):
        if limit is not None:
            late = F.col("max_loaded_at") < now - F.expr(f"interval {limit.interval}")
            status = F.when(late | F.col("max_loaded_at").isNull(), label).otherwise(status)
    return newest.select(
        F.lit(name).alias("unique_id"),
        "max_loaded_at",
        now.alias("snapshotted_at"),
        age.alias("max_loaded_at_time_ago_in_s"),
        status.alias("status"),
    )


def python_check(
    df: DataFrame,
    test: Callable[..., DataFrame],
    where: str | None = None,
    args: dict[str, Any] | None = None,
) -> DataFrame:
    """A user function from table to violations."""
    return test(df.where(where) if where else df, **(args or {}))


def row_check(
    df: DataFrame, test: Callable, where: str | None = None
) -> DataFrame:
    """A user function from a pandas batch to a boolean mask of the rows that pass.

    For row rules that need a Python package; batches arrive through Arrow.
    """
    rows = df.where(where) if where else df

    def failing(batches):
        for batch in batches:
            yield batch[~test(batch).astype(bool)]

    return rows.mapInPandas(failing, rows.schema)


# --- running checks -----------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named check on a table with the severity of its failure.

    Give either ``failing``, a predicate that is true for violating rows, or
    ``run``, a function from the table to its violations. The predicates of a
    table are all counted in one pass.
    """

    name: str
    run: Callable[[DataFrame], DataFrame] | None = None
    severity: str = "error"
    failure_count: Column | None = None  # default: the number of violating rows
    column: str | None = None
    failing: Callable[[], Column] | None = None

    def __post_init__(self) -> None:
        if self.severity not in ("error", "warn"):
            raise ValueError("severity must be 'error' or 'warn'")
        if (self.run is None) == (self.failing is None):
            raise ValueError("give either run or failing")


def failed_row_count(violations: DataFrame, measure: Column | None = None) -> DataFrame:
    """How badly a check failed: its measure over the violations, the row count by default."""
    return violations.agg(
        F.coalesce((measure if measure is not None else F.count(F.lit(1))).cast("bigint"), F.lit(0)).alias("failures")
    )


def run_checks(
    df: DataFrame, checks: list[Check], table: str, as_of: datetime | None = None
) -> DataFrame:
    """One result row per check: status ``pass``, ``warn`` or ``fail`` and the failure count."""
    detected = as_of_timestamp(as_of)

    def result(check: Check, failures: Column) -> Column:
        failed = "warn" if check.severity == "warn" else "fail"
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check.name).alias("test_name"),
            F.lit(check.column).cast("string").alias("column_name"),
            F.lit(check.severity).alias("severity"),
            F.when(failures == 0, "pass").otherwise(failed).alias("status"),
            failures.alias("failures"),
            detected.alias("detected_at"),
        )

    parts = []
    by_row = [c for c in checks if c.failing is not None]
    if by_row:
        counts = df.agg(*[F.count_if(c.failing()).alias(f"_{i}") for i, c in enumerate(by_row)])
        results = F.array(*[result(c, F.col(f"_{i}")) for i, c in enumerate(by_row)])
        parts.append(counts.select(F.inline(results)))
    for check in checks:
        if check.run is not None:
            counted = failed_row_count(check.run(df), check.failure_count)
            parts.append(counted.select(F.inline(F.array(result(check, F.col("failures"))))))
    return reduce(DataFrame.unionByName, parts)


def failing_rows(violations: DataFrame, result_id: str, sample: int | None = 5) -> DataFrame:
    """Violations as JSON rows under the id of their result; ``sample=None`` stores all."""
    rows = violations.limit(sample) if sample is not None else violations
    return rows.select(
        F.lit(result_id).alias("test_result_id"),
        F.to_json(F.struct(*violations.columns), {"ignoreNullFields": "false"}).alias("result_row"),
    )


def run_and_store(
    df: DataFrame,
    checks: list[Check],
    table: str,
    base: str,
    as_of: datetime | None = None,
    sample: int | None = 5,
) -> DataFrame:
    """Run checks, append their results below ``base``, and keep the failing rows of those that fail.

    Failing rows go to a folder of their own as JSON; ``sample=None`` keeps all.
    """
    run_id = uuid.uuid4().hex
    spark = df.sparkSession
    results = run_checks(df, checks, table, as_of).withColumn(
        "id", F.concat_ws(".", F.lit(run_id), "table_name", "test_name")
    )
    path = f"{base}/results/run={run_id}"
    results.coalesce(1).write.mode("errorifexists").parquet(path)
    stored = spark.read.schema(results.schema).parquet(path)
    # One row per declared check.
    failed = {r["test_name"]: r["id"] for r in stored.where(F.col("status") != "pass").collect()}
    for check in checks:
        if check.name in failed:
            bad = check.run(df) if check.run is not None else df.where(check.failing())
            rows = failing_rows(bad, failed[check.name], sample).withColumn("detected_at", as_of_timestamp(as_of))
            rows.write.mode("append").parquet(f"{base}/failures/{table}")
    return stored


# Column tests declared for the marts: table -> checks.
def mart_checks() -> dict[str, list[Check]]:
    def nn(column: str, severity: str = "error") -> Check:
        return Check(f"not_null_{column}", severity=severity, column=column, failing=lambda: F.col(column).isNull())

    return {
        "order_trips": [
            Check("unique_order_id", lambda df: unique(df, "order_id"), column="order_id"),
            nn("order_id"),
            nn("truck_id"),
            nn("total_distance_km", "warn"),
            nn("total_duration_min"),
            Check(
                "accepted_range_total_duration_min",
                column="total_duration_min",
                failing=lambda: ~F.col("total_duration_min").between(0, 120),
            ),
        ],
        "truck_activity": [nn("truck_id"), nn("activity_date"), nn("trips_completed")],
        "fleet_utilization": [nn("metric_date"), nn("truck_id"), nn("total_distance_km", "warn")],
        "otd": [nn("district"), nn("total_orders")],
        "district_heatmap": [nn("origin_district"), nn("order_count")],
    }
