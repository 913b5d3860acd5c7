"""Ordered month category.

R turns the month name into an ordered factor; here the order is an integer
ordinal beside the name.  A name outside the level list becomes null, as an
undeclared factor level becomes NA.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from insight.functions.nulls import ColumnLike, col_of

# The level order used by the analyses.
MONTHS = ["January", "February", "March", "April", "May", "June",
          "July", "August", "September", "October", "November", "December"]


def _month_map() -> Column:
    return F.create_map(*[x for i, m in enumerate(MONTHS, start=1) for x in (F.lit(m), F.lit(i))])


def month_ordinal(c: ColumnLike) -> Column:
    """1..12 for a listed English month name, null otherwise."""
    return F.try_element_at(_month_map(), col_of(c)).cast("int")


def month_name(ts: ColumnLike) -> Column:
    """English month name of a date/timestamp (zone-free)."""
    return F.date_format(col_of(ts), "MMMM")
