"""Grouped aggregates, shares and scalar totals.

Design rules (they decide the plan at scale):

* Every aggregate is a plain ``groupBy().agg()`` so Spark runs a partial
  (map-side) aggregate before the shuffle; a key holding a third of all rows
  is combined inside each map task and never travels as raw rows.
* A grand total is a global aggregate, which always returns exactly one row;
  attaching it to rows is a broadcast of that single row (``with_scalar``).
* Shares within a group join per-group totals back on the group key instead
  of a window, so no group is ever moved into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.functions.nulls import ColumnLike, col_of, r_divide, r_mean, r_sd, r_sum
from insight.operators.joins import nsjoin


def _cols(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a ONE-ROW frame (a global aggregate) to every row.

    The one-row side is broadcast; its size bound is structural (an
    aggregate without grouping keys yields exactly one row), so this is a
    broadcast nested-loop join with one build row: linear in ``df``.
    """
    return df.crossJoin(F.broadcast(one_row))


def grand_total(df: DataFrame, value: ColumnLike, name: str = "total", na_rm: bool = False) -> DataFrame:
    """AG1: one-row frame holding ``sum(value)`` (NA if any input is NA)."""
    return df.agg(r_sum(value, na_rm).alias(name))


def summarize(df: DataFrame, by: str | Sequence[str] | None, **aggs: Column) -> DataFrame:
    """``group_by(by) %>% summarize(name = agg, ...)``; NA is a group of its own."""
    named = [c.alias(n) for n, c in aggs.items()]
    keys = _cols(by)
    return df.groupBy(*keys).agg(*named) if keys else df.agg(*named)


def std_error(df: DataFrame, by: str | Sequence[str] | None, value: ColumnLike,
              name: str = "std_error", na_rm: bool = False) -> DataFrame:
    """AG10: standard error of the mean, ``sd / sqrt(n)`` per group."""
    v = col_of(value)
    n = F.count(v) if na_rm else F.count(F.lit(1))
    se = r_sd(value, na_rm) / F.sqrt(n.cast("double"))
    keys = _cols(by)
    return df.groupBy(*keys).agg(se.alias(name)) if keys else df.agg(se.alias(name))


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """WN2/JN5: ``value * 100 / sum(value)`` against the grand total of ``df``.

    The total comes from ``df`` itself (for a grouped input Spark reuses
    its shuffle), so the base table is scanned once.
    """
    tot = "__total"
    total = df.agg(r_sum(value).alias(tot))
    return (with_scalar(df, total)
            .withColumn(name, r_divide(F.col(value) * 100.0, F.col(tot)))
            .drop(tot))


def share_within(df: DataFrame, value: str, by: str | Sequence[str], name: str = "share") -> DataFrame:
    """WN1: ``value * 100 / sum(value)`` within the group ``by``.

    Per-group totals are aggregated (partial aggregation) and joined back on
    the group key; Spark broadcasts them when they are small and otherwise
    uses a shuffle join that AQE splits if one group is hot.
    """
    keys = _cols(by)
    tot = "__group_total"
    totals = df.groupBy(*keys).agg(r_sum(value).alias(tot))
    return (nsjoin(df, totals, keys, "left")  # null-safe: an NA group is a group
            .withColumn(name, r_divide(F.col(value) * 100.0, F.col(tot)))
            .drop(tot))



#: Exponents of two that one accumulator bin spans; the bits of a double's mantissa.
BIN_BITS, MANTISSA = 32, 52


def exact_sum(df: DataFrame, by: str | Sequence[str] | None, value: ColumnLike, name: str = "total") -> DataFrame:
    """T11: the sum of doubles, the same to the last bit whatever the partitioning.

    Each value is a whole number of units, the unit being a power of two that depends on
    its size: values are put in bins of ``BIN_BITS`` exponents, and a bin's units are
    summed as whole numbers (two halves, as decimals), which no order can change.  The
    bins' sums are added once per group, from the smallest bin, with compensation.  Nulls are left out; NaN
    or infinities of both signs make the sum NaN; a group without values has null.
    """
    x = col_of(value).cast("double")
    keys = _cols(by)
    size = F.abs("__x")
    # a bin whose unit divides the value: the logarithm may be off by one near a power of two, so one bit is spared
    bin_no = F.when(size > 0, F.floor((F.floor(F.log2(size)) - 1) / BIN_BITS)).otherwise(F.lit(0))
    shift = F.col("__bin") * BIN_BITS - MANTISSA
    half = F.floor(shift / 2)  # in two steps: the power itself may not be a double
    units = F.col("__x") / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), shift - half)
    high = F.floor(units / float(1 << 32))
    rows = df.select(*keys, x.alias("__x")).where("__x IS NOT NULL")
    finite = size < F.lit(float("inf"))
    parts = (rows.where(finite).withColumn("__bin", bin_no).withColumn("__units", units).withColumn("__high", high)
             .groupBy(*keys, "__bin").agg(F.sum(F.col("__high").cast("decimal(20,0)")).alias("__h"),
                                          F.sum((F.col("__units") - F.col("__high").cast("double") * float(1 << 32)).cast("decimal(12,0)")).alias("__l")))
    whole = (F.col("__h").cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("__l")).cast("double")
    worth = whole * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), shift - half)
    special = rows.where(~finite | F.isnan("__x")).groupBy(*keys).agg(F.sum("__x").alias("__special"))
    bins = F.array_sort(F.collect_list(F.struct("__bin", worth.alias("w"))))

    def add(a: Column, b: Column) -> Column:
        """One step of a compensated sum: what the addition rounds off is kept apart."""
        total = a["s"] + b["w"]
        lost = F.when(F.abs(a["s"]) >= F.abs(b["w"]), (a["s"] - total) + b["w"]).otherwise((b["w"] - total) + a["s"])
        return F.struct(total.alias("s"), (a["c"] + lost).alias("c"))

    sums = parts.groupBy(*keys).agg(F.when(F.count("__bin") > 0, F.aggregate(
        bins, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")), add, lambda a: a["s"] + a["c"])).alias("__sum"))
    if not keys:
        return with_scalar(sums, special).select(F.coalesce("__special", "__sum").alias(name))
    groups = df.select(*keys).distinct()
    out = nsjoin(nsjoin(groups, sums, keys, "left"), special, keys, "left")
    return out.select(*keys, F.coalesce("__special", "__sum").alias(name))
