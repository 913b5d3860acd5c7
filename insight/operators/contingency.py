"""Frequency and contingency tables with zero cells (EX7-EX9, AG15).

R's ``table()`` reports every combination of the observed levels, zero cells
included, and leaves NA out.  The table is scanned once: its rows are counted
by group (partial aggregation), the grouped counts are stored, and everything
else -- level sets, the grid of their combinations, zero fill -- is made from
these counts.  The grid is the product of the level sets because the zero
cells are the operator's result; its size depends on the levels, not on the
number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.operators.profile import _q
from insight.sources.checkpoint import materialize


def frequency(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """EX7: one-way table, NA left out."""
    return (df.filter(_q(column).isNotNull()).groupBy(_q(column).alias(column))
            .agg(F.count(F.lit(1)).alias(name)))


def _counts(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    cols = list(columns)
    counts = df.select(*[_q(c) for c in cols]).dropna().groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias(name))
    return materialize(counts, "table-counts")


def _level_grid(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All combinations of the levels that occur in the grouped counts."""
    grid = None
    for c in columns:
        levels = counts.select(_q(c)).distinct()
        grid = levels if grid is None else grid.crossJoin(levels)
    return grid


def crosstab(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """EX8/EX9: n-way table in long form with zero cells, NA rows left out."""
    cols = list(columns)
    counts = _counts(df, cols, name)
    return (_level_grid(counts, cols).join(counts, on=cols, how="left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long"))))


def confusion(pred: DataFrame, truth: str, predicted: str, levels: DataFrame | None = None,
              name: str = "n") -> DataFrame:
    """AG15: confusion counts over a shared label set, zero cells included.

    ``levels`` is a frame ``(label, level)`` (e.g. labels in first-appearance
    order); by default the sorted union of both columns.  Output:
    ``truth, predicted, n, truth_level, predicted_level``.
    """
    counts = _counts(pred, [truth, predicted], name)
    if levels is None:
        labs = (pred.select(F.col(truth).alias("label")).union(pred.select(F.col(predicted).alias("label")))
                .dropna().distinct())
        # one row per distinct label
        levels = labs.withColumn("level", F.dense_rank().over(Window.orderBy("label")))
    rows = levels.select(F.col("label").alias(truth), F.col("level").alias("truth_level"))
    cols = levels.select(F.col("label").alias(predicted), F.col("level").alias("predicted_level"))
    grid = rows.crossJoin(cols).select(truth, predicted, "truth_level", "predicted_level")
    return (grid.join(counts, on=[truth, predicted], how="left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long"))))


#: Levels that a wide table can have as columns.
MOST_COLUMNS = 10_000


def crosstab_wide(df: DataFrame, row: str, column: str, most: int = MOST_COLUMNS) -> DataFrame:
    """EX8 wide form: one row per level of ``row``, one count column per level
    of ``column`` (named by the level), zero cells as 0, NA rows left out.

    Column levels become column names, so they are read from the grouped counts
    first; over ``most`` of them are refused (use :func:`crosstab`, the long form).
    """
    counts = _counts(df, [row, column], "n")
    levels = counts.select(_q(column)).distinct()
    if levels.limit(most + 1).count() > most:
        raise ValueError(f"column {column!r} has more than {most} levels; use crosstab for the long form")
    values = [r[0] for r in levels.orderBy(_q(column)).collect()]
    wide = counts.groupBy(_q(row)).pivot(column, values).agg(F.sum("n"))
    return wide.fillna(0, subset=[str(v) for v in values])
