"""Correlation matrix, box-plot statistics, histogram / pair bins, censoring.

All statistics are one or two aggregation passes with partial aggregation;
wide results are produced in long form ``(var_x, var_y, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.functions.nulls import ColumnLike, col_of
from insight.operators.aggregate import with_scalar
from insight.operators.blocks import comoments, pair_counts
from insight.operators.joins import nsjoin
from insight.operators.quantiles import quantile_columns
from insight.sources.checkpoint import materialize


def censor(c: ColumnLike, lo: float, hi: float) -> Column:
    """FL7: axis limits -- a value outside ``[lo, hi]`` (or NaN) becomes null."""
    x = col_of(c)
    return F.when(x.between(F.lit(lo), F.lit(hi)), x)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def correlation_long(df: DataFrame, columns: Sequence[str], digits: int | None = 6,
                     na_propagate: bool = True) -> DataFrame:
    """AG12: Pearson correlation of every ordered column pair, long form.

    Output ``var_x, var_y, ord_x, ord_y, r``.  As R's ``cor`` default, a null
    or NaN anywhere in either column makes the cell null (``na_propagate``); with
    ``na_propagate=False`` rows are used pairwise.  A constant column gives null.

    One scan for any number of columns: :func:`insight.operators.blocks.comoments`.
    """
    cols = list(columns)
    usable = (F.col("n") > 1) & (F.col("sq_i") > 0) & (F.col("sq_j") > 0)
    if na_propagate:
        usable = usable & (F.col("n") == F.col("rows"))
    r = F.when(usable, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.col("cross") / F.sqrt(F.col("sq_i") * F.col("sq_j"))))
    if digits is not None:
        r = F.round(r, digits)
    names = F.array(*[F.lit(c) for c in cols])
    return comoments(df, cols).select(F.element_at(names, F.col("i") + 1).alias("var_x"), F.element_at(names, F.col("j") + 1).alias("var_y"),
                                      F.col("i").alias("ord_x"), F.col("j").alias("ord_y"), r.alias("r"))


def upper_triangle(corr: DataFrame, include_diagonal: bool = True) -> DataFrame:
    """AG13: cells with ``ord_x <= ord_y`` (or ``<`` without the diagonal)."""
    cond = F.col("ord_x") <= F.col("ord_y") if include_diagonal else F.col("ord_x") < F.col("ord_y")
    return corr.filter(cond)


def _points(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """The columns and the value as ``__v``, where it is a number, stored: the input is computed once."""
    v = F.col(value).cast("double")
    return materialize(df.filter(v.isNotNull() & ~F.isnan(v)).select(*columns, v.alias("__v")), "points")


def boxplot_stats(df: DataFrame, by: Sequence[str], value: str, coef: float = 1.5) -> DataFrame:
    """PD6: hinges, whiskers and outlier counts per group (ggplot's box plot).

    Hinges are exact type-7 quartiles.  Whiskers are the furthest points within
    ``coef * IQR`` of the hinges.  The per-group statistics (one row per group)
    are joined back null-safely and a second partial aggregate finds whiskers
    and outlier counts.
    """
    keys = list(by)
    points = _points(df, keys, value)
    hinges = quantile_columns(points, keys, "__v", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    hinges = (hinges.withColumn("__lo", F.col("q1") - coef * (F.col("q3") - F.col("q1")))
                    .withColumn("__hi", F.col("q3") + coef * (F.col("q3") - F.col("q1"))))
    pts = nsjoin(points, hinges, keys)
    inside = F.col("__v").between(F.col("__lo"), F.col("__hi"))
    return (pts.groupBy(*keys, "n", "q1", "median", "q3")
            .agg(F.min(F.when(inside, F.col("__v"))).alias("lower_whisker"),
                 F.max(F.when(inside, F.col("__v"))).alias("upper_whisker"),
                 F.count(F.when(~inside, F.lit(1))).alias("n_outliers")))


def boxplot_outliers(df: DataFrame, by: Sequence[str], value: str, key: Sequence[str] = (),
                     coef: float = 1.5) -> DataFrame:
    """PD6: the points beyond the whiskers, one row each (``by``, ``key``, value)."""
    keys = list(by)
    points = _points(df, [*keys, *key], value)
    h = quantile_columns(points, keys, "__v", [0.25, 0.75], ["q1", "q3"])
    fences = h.select(*keys, (F.col("q1") - coef * (F.col("q3") - F.col("q1"))).alias("__lo"),
                      (F.col("q3") + coef * (F.col("q3") - F.col("q1"))).alias("__hi"))
    pts = nsjoin(points.withColumnRenamed("__v", value), fences, keys)
    return (pts.filter(~F.col(value).between(F.col("__lo"), F.col("__hi")))
            .drop("__lo", "__hi"))


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1 over [lo, hi]; a constant column is bin 0."""
    raw = F.floor((x - lo) / (hi - lo) * float(bins))
    return (F.when(x.isNull(), F.lit(None))
            .when(hi == lo, F.lit(0))
            .otherwise(F.least(raw, F.lit(bins - 1)))).cast("int")


def _finite(name: str) -> Column:
    """The value as a double; NaN and infinities, which have no bin, become null."""
    x = _q(name).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def _ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(_finite(c)).alias(f"__min{i}"), F.max(_finite(c)).alias(f"__max{i}")]
    return df.agg(*aggs)


def histogram_long(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """PD7 diagonal: equal-width histogram of each column, ``(var, bin, var_min, var_max, n)``.

    One pass for the ranges, one for the counts; rows are exploded into
    ``(column index, bin)`` pairs and counted on integer keys; the ranges ride
    along in the aggregate and the names are attached to the small result.
    """
    cols = list(columns)
    withr = with_scalar(df.select(*[_q(c) for c in cols]), _ranges(df, cols))
    items = [F.struct(F.lit(i).alias("v"), _bin(_finite(c), F.col(f"__min{i}"), F.col(f"__max{i}"), bins).alias("bin"),
                      F.col(f"__min{i}").alias("lo"), F.col(f"__max{i}").alias("hi"))
             for i, c in enumerate(cols)]
    counts = (withr.select(F.inline(F.array(*items)))
              .filter(F.col("bin").isNotNull())
              .groupBy("v", "bin").agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("var_min"),
                                       F.first("hi").alias("var_max")))
    names = F.array(*[F.lit(c) for c in cols])
    return counts.select(F.element_at(names, F.col("v") + 1).alias("var"), "bin", "var_min", "var_max", "n")


def pair_bins(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """PD7 off-diagonal: 2-D bin counts for every column pair (instead of all
    points), ``(var_x, var_y, bin_x, bin_y, n)``.  Rows with a null (or
    NaN, or an infinity) in either column of a pair are left out of that pair.

    One pass for the ranges and one for the counts, which every task sums up for all
    pairs before anything is shuffled (:func:`insight.operators.blocks.pair_counts`).
    """
    cols = list(columns)
    withr = with_scalar(df.select(*[_q(c) for c in cols]), _ranges(df, cols))
    bin_of = [_bin(_finite(c), F.col(f"__min{i}"), F.col(f"__max{i}"), bins) for i, c in enumerate(cols)]
    names = F.array(*[F.lit(c) for c in cols])
    return pair_counts(withr, bin_of, bins).select(
        F.element_at(names, F.col("i") + 1).alias("var_x"), F.element_at(names, F.col("j") + 1).alias("var_y"),
        F.col("bin_i").alias("bin_x"), F.col("bin_j").alias("bin_y"), "n")
