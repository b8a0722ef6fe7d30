"""Equality of large tables by digests of key buckets.

Both sides are reduced to a row a bucket where they lie; rows are compared,
and moved for it, in buckets whose digests differ only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from drayline.operators.reshape import except_both_ways

#: Buckets of the key space: the most rows a task sends, and what is broadcast when buckets differ.
BUCKETS = 4096
_BUCKET = "_bucket"
_PARTS = ["_rows", "_low", "_high", "_third"]


def _hashable(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        # The hash functions pass over nulls inside of nested values, the text keeps them.
        return F.to_json(F.struct(column), {"ignoreNullFields": "false"})
    return column


def _values(df: DataFrame, columns: list[str]) -> list[Column]:
    """The columns and, as nulls leave a hash as it is, one text that says which are null."""
    holes = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    return [*[_hashable(df.schema[c]) for c in columns], holes]


def _bucket(df: DataFrame, key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(17), *_values(df, key)), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, key: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """One row a bucket of the key: the number of rows and sums of row hashes.

    The sums do not depend on the order of rows and count repeated ones. Two
    buckets of other rows have equal digests with a chance of about 2^-96. The
    outcome may be stored and compared with later ones of the same arguments.
    """
    names = df.columns
    values = _values(df, names)
    wide, third = F.xxhash64(*values), F.hash(F.lit(5), *values)
    half = F.lit(0xFFFFFFFF).cast("bigint")
    # Sums of 32 bits stay within 64 for two thousand million rows a bucket.
    hashed = df.select(
        _bucket(df, key or names, buckets).alias(_BUCKET),
        wide.bitwiseAND(half).alias("_l"),
        F.shiftrightunsigned(wide, 32).alias("_h"),
        third.cast("bigint").alias("_t"),
    )
    return hashed.groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("_l").alias("_low"), F.sum("_h").alias("_high"), F.sum("_t").alias("_third")
    )


def differing_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Buckets whose digests are not the same on both sides, at most as many as there are buckets."""
    other = b.select(F.col(_BUCKET).alias("_other"), *[F.col(p).alias(f"_o{p}") for p in _PARTS])
    same = F.col("_rows").eqNullSafe(F.col("_o_rows"))
    for p in _PARTS[1:]:
        same = same & F.col(p).eqNullSafe(F.col(f"_o{p}"))
    joined = a.join(other, F.col(_BUCKET) == F.col("_other"), "full")
    return joined.where(~same).select(F.coalesce(_BUCKET, "_other").alias(_BUCKET))


def equality_by_digest(
    df: DataFrame,
    compare: DataFrame,
    key: list[str] | None = None,
    columns: list[str] | None = None,
    keep_duplicates: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows found in only one of the tables, as ``checks.equality`` gives them.

    Each side is read for its digests and, where buckets differ, again for
    those; equal tables send their digests and no row. ``key`` groups changed
    rows into fewer buckets if it names what identifies a row; by default a
    row's bucket follows from all of its columns. A null is a value like others.
    """
    names = columns or df.columns
    a, b = df.select(*names), compare.select(*names)
    key = key or names
    digests = [bucket_digests(side, key, buckets) for side in (a, b)]
    # At most ``buckets`` numbers: safe to broadcast, and rows stay where they are read.
    listed = F.broadcast(differing_buckets(*digests))
    near = [side.withColumn(_BUCKET, _bucket(side, key, buckets)).join(listed, _BUCKET, "left_semi").select(*names) for side in (a, b)]
    return except_both_ways(*near, keep_duplicates)
