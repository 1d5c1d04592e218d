"""Row filters (F*): all are plain predicates so Catalyst can push them into the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop rows with a null in any of the listed columns."""
    return df.dropna(how="any", subset=list(cols))


def null_or_in(col: str, values: Sequence) -> Column:
    """null, or one of the values."""
    return F.col(col).isNull() | F.col(col).isin(list(values))


def digits_only(col: str) -> Column:
    """the whole value is decimal digits."""
    return F.col(col).rlike(r"^\d+$")


def half_open(col: str, start, end) -> Column:
    """start <= col < end (pushed down as two range predicates)."""
    return (F.col(col) >= F.lit(start)) & (F.col(col) < F.lit(end))


def iso_string_at_least(col: str, lower: str) -> Column:
    """lexical lower bound on ISO-8601 date strings (valid because the format sorts)."""
    return F.col(col) >= F.lit(lower)


def any_not_equal(cols: Sequence[str], value) -> Column:
    """keep rows where at least one column differs from ``value``; nulls follow SQL rules."""
    out = None
    for c in cols:
        cond = F.col(c) != F.lit(value)
        out = cond if out is None else (out | cond)
    return out


def not_adjusted(mp_a: str, mp_b: str) -> Column:
    """drop director adjustments: a negative MP on either side, or MP sum equal to 0."""
    return ~((F.col(mp_a) < 0) | (F.col(mp_b) < 0)) & ~((F.col(mp_a) + F.col(mp_b)) == 0)


def in_year(col: str, year: int) -> Column:
    """``year(col) = y`` written as a half-open range so Parquet statistics prune row groups."""
    return half_open(col, F.lit(date(year, 1, 1)).cast("timestamp_ntz"),
                     F.lit(date(year + 1, 1, 1)).cast("timestamp_ntz"))


def in_keys(df: DataFrame, col: str, keys: Sequence | DataFrame) -> DataFrame:
    """membership of the stringified column in a key list or a one-column frame: a left-semi join."""
    s = F.col(col).cast("string")
    if not isinstance(keys, DataFrame):
        keys = df.sparkSession.createDataFrame([(str(k),) for k in keys], "_key string")
    k = keys.select(F.col(keys.columns[0]).cast("string").alias("_key"))
    return df.join(k, s == F.col("_key"), "left_semi")


def contains_ci(cols: Sequence[str], needle: str) -> Column:
    """case-insensitive literal substring in any of the columns (not a LIKE pattern)."""
    n = needle.lower()
    out = None
    for c in cols:
        cond = F.coalesce(F.lower(F.col(c).cast("string")).contains(n), F.lit(False))
        out = cond if out is None else (out | cond)
    return out


def row_contains(cols: Sequence[str], needle: str) -> Column:
    """any non-null cell of the row contains the needle (case-insensitive)."""
    return contains_ci(cols, needle)
