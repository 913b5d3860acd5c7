"""Sorting and tie-keeping top-n.

``top_n(n)`` keeps every row whose rank-with-gaps (``min_rank`` of the
descending weight) is at most ``n``: ties at the cut are all kept, rows with
a missing weight are dropped.

* Global top-n never ranks the whole frame in one task.  The ``n``-th
  largest weight is found with a distributed take-ordered (each task keeps
  its own ``n`` best, then a merge of ``n * tasks`` values), and the frame is
  filtered against that one-row threshold.  ``w >= n-th largest`` is exactly
  ``min_rank(desc(w)) <= n``.
* Per-group top-n is ``rank() <= n`` over a window partitioned by the group;
  Spark inserts a partial ``WindowGroupLimit`` before the shuffle, so a hot
  group ships only its local top candidates, not all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insight.operators.aggregate import with_scalar


def _cols(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def top_n(df: DataFrame, n: int, weight: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Rows with ``min_rank(desc(weight)) <= n``, within ``by`` groups if given."""
    if n < 1:
        raise ValueError("n must be >= 1")
    w = F.col(weight)
    present = df.filter(w.isNotNull())
    keys = _cols(by)
    if keys:
        rk = "__rank"
        win = Window.partitionBy(*keys).orderBy(w.desc())
        return present.withColumn(rk, F.rank().over(win)).filter(F.col(rk) <= n).drop(rk)
    thr = "__threshold"
    threshold = present.select(w.alias(thr)).orderBy(F.col(thr).desc()).limit(n).agg(F.min(thr).alias(thr))
    return with_scalar(present, threshold).filter(w >= F.col(thr)).drop(thr)


def first_rows(df: DataFrame, key: str | Sequence[str], n: int = 6) -> DataFrame:
    """EX1 / SO5: first ``n`` rows by key (distributed take-ordered)."""
    return df.orderBy(*[F.col(k).asc() for k in _cols(key)]).limit(n)


def last_rows(df: DataFrame, key: str | Sequence[str], n: int = 6) -> DataFrame:
    """EX2: last ``n`` rows by key, returned in ascending key order."""
    keys = _cols(key)
    return df.orderBy(*[F.col(k).desc() for k in keys]).limit(n).orderBy(*keys)


def ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` sorted over range partitions and stored, with ``__part`` and ``__at``.

    Spark's range partitioning deals the rows by the ``order`` columns (use a
    combination without repeats: all rows of one value go to one range); each
    partition is sorted and its rows are numbered from 0 where they stand.
    Partitions are numbered in order, so the position of a row is the number of
    rows in earlier partitions plus ``__at``.  The result is written once:
    every reader sees the same numbers.
    """
    from insight.sources.checkpoint import materialize
    number = F.monotonically_increasing_id()  # partition number in the high bits, place in it below
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", number)
    return materialize(cut.withColumn("__part", F.shiftright("__id", 33))
                       .withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id"), "ranged")


def row_positions(df: DataFrame, key: str, name: str = "row") -> DataFrame:
    """1-based position of every row in ``key`` order, without a single-task sort.

    Null keys come first, as in an ascending sort.  Equal keys get consecutive
    positions in an arbitrary order; a row id as a second sort column
    spreads them (nulls too) over ranges.  Row counts per range -- one row per
    range -- become offsets.
    """
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    rows = ranged(tied, [key, "__tie"]).drop("__tie")
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__off"))
    return (rows.join(F.broadcast(offsets), "__part")
            .withColumn(name, F.col("__off") + F.col("__at") + 1)
            .drop("__part", "__at", "__off"))
