"""Missing-value and arithmetic rules (R semantics on Spark columns).

Spark SQL skips nulls in aggregates and, with ANSI mode on, raises on a zero
divisor.  The analyses we rebuild expect R behaviour instead:

* ``x / 0`` is ``+Inf``/``-Inf`` and ``0 / 0`` is ``NaN``; NA in, NA out.
* ``sum``/``mean``/``sd`` without ``na.rm`` give NA as soon as one input is NA.

These helpers express both rules with plain ``when`` expressions so they stay
inside whole-stage codegen and never depend on ``spark.sql.ansi.enabled``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Division with R results: NA if either side is NA, +-Inf / NaN for a zero divisor.

    The null test comes first: a null numerator over a zero divisor is NA,
    not NaN.  The zero test short-circuits before the division, so ANSI mode
    never sees a zero divisor.
    """
    n = col_of(numerator).cast("double")
    d = col_of(denominator).cast("double")
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when(d == 0.0,
              F.when(n > 0, F.lit(float("inf")))
              .when(n < 0, F.lit(float("-inf")))
              .otherwise(F.lit(float("nan"))))
        .otherwise(n / d)
    )


def na_agg(agg: Column, c: ColumnLike, na_rm: bool = False) -> Column:
    """Wrap an aggregate so that one NA input makes the result NA (R default).

    ``count(c) == count(*)`` is evaluated in the same aggregation pass, so the
    guard costs no extra scan.  With ``na_rm=True`` the SQL behaviour
    (skip nulls) is kept.
    """
    if na_rm:
        return agg
    return F.when(F.count(col_of(c)) == F.count(F.lit(1)), agg)


def r_sum(c: ColumnLike, na_rm: bool = False) -> Column:
    return na_agg(F.sum(col_of(c)), c, na_rm)


def r_mean(c: ColumnLike, na_rm: bool = False) -> Column:
    return na_agg(F.avg(col_of(c)), c, na_rm)


def r_sd(c: ColumnLike, na_rm: bool = False) -> Column:
    """Sample standard deviation; one row gives NA (null) as in R."""
    return na_agg(F.stddev_samp(col_of(c)), c, na_rm)


def is_na(c: ColumnLike, floating: bool = True) -> Column:
    """R ``is.na``: true for null and, on floating columns, for NaN."""
    c = col_of(c)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def fill_na(c: ColumnLike, value) -> Column:
    """``coalesce(c, value)``; the name is kept by the caller."""
    return F.coalesce(col_of(c), F.lit(value))


def recode(c: ColumnLike, mapping: Mapping) -> Column:
    """Replace listed values, leave every other value (and null) untouched.

    Equivalent to a chain of R ``replace(x, x == old, new)`` calls applied
    one after the other, so a later rule sees the output of an earlier one.
    """
    out = col_of(c)
    for old, new in mapping.items():
        out = F.when(out == F.lit(old), F.lit(new)).otherwise(out)
    return out
