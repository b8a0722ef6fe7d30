"""String functions: keys, URLs, concatenation, column-name clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from drayline.functions._args import as_col, require_list

__all__ = [
    "concat_with_separator",
    "contains_text",
    "empty_to_null",
    "get_url_host",
    "get_url_parameter",
    "get_url_path",
    "metric_id",
    "slugify",
    "surrogate_key",
]

# Fixed value: what a null field contributes to a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def _hashed(fields, null_part: str, function: str) -> Column:
    parts = [
        F.coalesce(as_col(f).cast("string"), F.lit(null_part)) for f in require_list(fields, function)
    ]
    return F.md5(F.concat_ws("-", *parts))


def surrogate_key(fields, nulls_as_empty: bool = False) -> Column:
    """md5 of the dash-joined fields; a null is distinct from the empty string."""
    return _hashed(fields, "" if nulls_as_empty else NULL_KEY_PART, "surrogate_key")


def metric_id(fields) -> Column:
    """md5 of the dash-joined fields, null and empty string alike."""
    return _hashed(fields, "", "metric_id")


def get_url_host(url) -> Column:
    """Host of a URL, with or without a scheme."""
    bare = F.regexp_replace(as_col(url), r"android-app://|https?://", "")
    return F.regexp_extract(bare, r"^([^/?]*)", 1)


def get_url_path(url) -> Column:
    """Path of a URL without the leading slash and the query string.

    A URL with neither a slash nor a query string is returned as it stands.
    """
    bare = F.regexp_replace(as_col(url), r"https?://", "")
    slash = F.instr(bare, "/")
    query = F.instr(bare, "?")
    start = F.when(slash > 0, slash).otherwise(query - 1)
    return F.split_part(F.substring(bare, start + 1, F.length(bare)), F.lit("?"), F.lit(1))


def get_url_parameter(url, parameter: str) -> Column:
    """Value of one query parameter, null when absent or empty."""
    after = F.split_part(as_col(url), F.lit(f"{parameter}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))


def contains_text(string, substring: str, case_sensitive: bool = False) -> Column:
    text = as_col(string)
    if case_sensitive:
        return F.contains(text, F.lit(substring))
    return F.contains(F.lower(text), F.lit(substring.lower()))


def concat_with_separator(fields, separator: str = "; ", null_text: str = "NULL") -> Column:
    """Join the fields into one string, showing a null as ``NULL``."""
    parts = [
        F.coalesce(as_col(f).cast("string"), F.lit(null_text))
        for f in require_list(fields, "concat_with_separator")
    ]
    return F.concat_ws(separator, *parts)


def empty_to_null(column) -> Column:
    return F.nullif(as_col(column), F.lit(""))


def slugify(name: str) -> str:
    """Turn arbitrary text into a column name."""
    slug = re.sub(r"[ -]+", "_", name.lower())
    slug = re.sub(r"[^a-z0-9_]+", "", slug)
    return f"_{slug}" if slug[:1].isdigit() else slug
