"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Floats of query results are rounded to so many digits.
DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Present every float/double column at ``digits`` digits, halves away from zero.

    Operators stay unrounded; only registered query outputs pass through here.  Values are first
    brought to three digits more, so that a sum's last bits, which depend on the order of
    summation, cannot decide a half.  The same steps run in the DuckDB twin :func:`r`.
    """
    cols = []
    fine, step, scale = float(10 ** (digits + 3)), 1000.0, float(10 ** digits)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # "+ 0.0" turns a -0.0 (from rounding a small negative) into 0.0 in both engines
            cols.append((F.round(F.round(c.cast("double") * fine) / step) / scale + F.lit(0.0)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def money(col: str) -> F.Column:
    """Sums of cent values are exact decimals: present them at 2 digits."""
    return F.round(F.col(col), 2).alias(col)


def r(expr: str, digits: int = DIGITS) -> str:
    """SQL twin of :func:`rounded` for one expression."""
    return f"(ROUND(ROUND(CAST({expr} AS DOUBLE) * 1e{digits + 3}) / 1e3) / 1e{digits} + 0.0)"
