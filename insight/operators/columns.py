"""Column selection and derivation (PJ1-PJ6, PJ13, PJ14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.operators.profile import NUMERIC, _q


def mutate(df: DataFrame, *steps: tuple[str, Column]) -> DataFrame:
    """PJ1: add/overwrite columns in order; each step sees the earlier ones.

    (``withColumns`` evaluates all expressions against the input, so it does
    not give R's sequential ``mutate`` semantics; chained ``withColumn``
    collapses into one projection in Catalyst.)
    """
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df


def select_numeric(df: DataFrame) -> DataFrame:
    """PJ4: ``select_if(is.numeric)``: dates, strings and booleans are left out."""
    return df.select(*[_q(f.name) for f in df.schema.fields if isinstance(f.dataType, NUMERIC)])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PJ3: ``select(-c(...))``."""
    return df.drop(*columns)


def column_totals(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AG11: ``colSums(x)`` and ``colSums(x != 0)`` in one job, long form
    ``(column, col_sum, n_nonzero)``.  ``col_sum`` is NA if the column holds
    an NA (R's colSums default); ``n_nonzero`` too (``NA != 0`` is NA)."""
    cols = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)])
    n_all = F.count(F.lit(1))
    aggs, rows = [], []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        full = F.count(x) == n_all
        aggs += [F.when(full, F.sum(x)).alias(f"s{i}"),
                 F.when(full, F.count_if(x != 0)).alias(f"z{i}")]
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(i + 1).alias("position"),
                             F.col(f"s{i}").alias("col_sum"), F.col(f"z{i}").alias("n_nonzero")))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _keep(df: DataFrame, predicate: str) -> DataFrame:
    totals = column_totals(df)
    keep = [r["column"] for r in totals.filter(predicate).select("column", "position")
            .orderBy("position").collect()]
    return df.select(*[_q(c) for c in keep])


def keep_nonzero_columns(df: DataFrame) -> DataFrame:
    """PJ5: ``x[, colSums(x != 0) > 0]`` -- data-dependent, so two jobs by
    nature: one aggregate decides the column list (p names reach the
    driver, never rows), then a projection."""
    return _keep(df, "n_nonzero > 0")


def keep_positive_sum_columns(df: DataFrame) -> DataFrame:
    """PJ6: ``x[, colSums(x) > 0]``.  R errors on an NA sum; here such a
    column is dropped (documented difference)."""
    return _keep(df, "col_sum > 0")


def as_category(c: str | Column) -> Column:
    """PJ13: ``factor(x)`` for a 0/1 number: its text form."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))


def label_levels(c: str | Column, labels: Mapping) -> Column:
    """PJ14: map category levels to display labels (unlisted -> null)."""
    x = F.col(c) if isinstance(c, str) else c
    out = None
    for level, label in labels.items():
        out = (F.when(x == F.lit(level), F.lit(label)) if out is None
               else out.when(x == F.lit(level), F.lit(label)))
    return out


# The status labels of the cancellation flag.  The reference
# passes them in the order (Cancelled, Not Cancelled) for levels (0, 1),
# which swaps them; level 0 means "not cancelled".
CANCEL_LABELS = {0.0: "Not Cancelled", 1.0: "Cancelled"}
