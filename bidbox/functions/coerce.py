"""Type coercion, lenient dates and JSON-array helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: date layouts seen in result files, tried in this order
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd", "yyyyMMddHH:mm")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lenient_timestamp(col: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """C17: first format that parses wins; unparsable text -> null (never an error)."""
    x = _c(col).cast("string")
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in formats])


def lenient_date_in_range(col: str | Column, start: str, end: str,
                          formats: Sequence[str] = DATE_FORMATS) -> Column:
    """keep rows whose parsed date is in [start, end) and rows whose date does not parse."""
    d = F.to_date(lenient_timestamp(col, formats))
    return d.isNull() | ((d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date")))


def coerce_text(col: str | Column, declared_type: str, nullable: bool = True) -> Column:
    """Canonical text of a landed (all-string) cell under a declared SQL type.

    INT/BOOL: 'true'/'false' -> '1'/'0', signed digits -> normalised integer, other text kept.
    REAL/FLOAT/DOUBLE: parseable -> float text, other text kept.  TEXT: kept.
    Null/'' -> null when the column is nullable (numeric) else ''.  NOT NULL is never null.
    """
    s = _c(col).cast("string")
    affinity = _affinity(declared_type)
    if affinity == "text":
        return s if nullable else F.coalesce(s, F.lit(""))
    given = F.nullif(s, F.lit(""))
    text = F.coalesce(_CANONICAL[affinity](given), given)
    return text if nullable else F.coalesce(text, F.lit(""))


def _affinity(declared_type: str) -> str:
    name = declared_type.upper()
    if name == "BOOL" or "INT" in name:
        return "integer"
    return "real" if any(part in name for part in ("REAL", "FLOA", "DOUB")) else "text"


# for each numeric affinity the canonical text of a cell, null where the cell is no such value
_CANONICAL = {
    "integer": lambda s: F.coalesce(F.create_map(F.lit("true"), F.lit("1"), F.lit("false"), F.lit("0"))[F.lower(s)],
                                    F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("long")).cast("string")),
    "real": lambda s: s.try_cast("double").cast("string"),
}


def json_string_array(col: str | Column) -> Column:
    """JSON array text -> array<string> (malformed -> null)."""
    return F.from_json(_c(col), "array<string>")


def pad_to(arr: Column, n: int = 2) -> Column:
    """Pad with nulls / trim to exactly n elements."""
    nulls = F.array(*[F.lit(None).cast("string") for _ in range(n)])
    return F.slice(F.concat(F.coalesce(arr, F.array().cast("array<string>")), nulls), 1, n)
