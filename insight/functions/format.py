"""Number formatting and rounding.

``fixed2`` mirrors C ``sprintf("%0.2f", x)``: ``format_number(x, '0.00')``
rounds the binary value as C does (0.125 -> "0.12", 1.005 -> "1.00"), has no
thousands separator and keeps null as null.  R prints the special values as
``Inf``, ``-Inf``, ``NaN`` and ``NA``; those are mapped explicitly because
Spark would print the infinity sign.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from insight.functions.nulls import ColumnLike, col_of


def fixed(c: ColumnLike, digits: int = 2) -> Column:
    x = col_of(c).cast("double")
    pattern = "0." + "0" * digits if digits > 0 else "0"
    return (
        F.when(x.isNull(), F.lit("NA"))
        .when(F.isnan(x), F.lit("NaN"))
        .when(x == float("inf"), F.lit("Inf"))
        .when(x == float("-inf"), F.lit("-Inf"))
        .otherwise(F.call_function("format_number", x, F.lit(pattern)))
    )


def fixed2(c: ColumnLike) -> Column:
    """Text with two decimals, as ``sprintf("%0.2f", x)``."""
    return fixed(c, 2)


def round_half_up(c: ColumnLike, digits: int = 2) -> Column:
    """``round(x, digits)``.  Spark and DuckDB round half away from zero;
    R rounds to even at exact binary ties -- a documented difference."""
    return F.round(col_of(c), digits)
