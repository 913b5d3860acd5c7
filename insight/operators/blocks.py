"""Mergeable per-task summaries of many columns at once: co-moments and pair counts.

A plain aggregate with one sum per pair of columns grows its generated code with the
square of the number of columns and scans the input again and again.  Here a task
summarises its rows in numpy, a batch at a time, in one scan for any number of columns;
the summaries are combined pairwise.  A summary's size depends on the number of columns
only, never on the rows.

Co-moments of columns i and j are taken over the rows where both are present: their
number, the means, the centred squares and cross-products.  Batches are centred before
they are summed and summaries are merged by the difference of their means (Chan et al.),
so large offsets do not cancel; a constant column has exact zeros.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.sources.checkpoint import materialize

# functions that run in tasks travel with the plan, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Summaries that one task combines.
FAN = 64


class Moments:
    """Numbers, means, squares and cross-products of all ordered pairs of p columns, as (4, p, p)."""

    def __init__(self, parts: np.ndarray):
        self.n, self.mean, self.sq, self.cross = parts

    @classmethod
    def of_rows(cls, x: np.ndarray) -> Moments:
        """From rows (r, p); NaN is missing."""
        p = x.shape[1]
        here = ~np.isnan(x)
        first = np.where(here.any(axis=0), x[here.argmax(axis=0), np.arange(p)], 0.0)
        z = np.where(here, x - first, 0.0)
        middle = z.sum(axis=0) / np.maximum(here.sum(axis=0), 1)
        z = np.where(here, z - middle, 0.0)
        if here.all():
            n = np.full((p, p), float(len(x)))
            total, sq = (np.repeat(v.sum(axis=0)[:, None], p, axis=1) for v in (z, z * z))
        else:
            mask = here.astype(float)
            n, total, sq = mask.T @ mask, z.T @ mask, (z * z).T @ mask
        mean = total / np.maximum(n, 1)
        return cls(np.stack([n, np.where(n > 0, mean + (first + middle)[:, None], 0.0), sq - mean * total, z.T @ z - mean * total.T]))

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        share = other.n / np.maximum(n, 1)
        step = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * share
        mean = np.where(self.n > 0, self.mean + step * share, other.mean)
        return Moments(np.stack([n, mean, self.sq + other.sq + step * step * weight, self.cross + other.cross + step * step.T * weight]))

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.sq, self.cross]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes, p: int) -> Moments:
        return cls(np.frombuffer(data).reshape(4, p, p))


_BLOCK = "part bigint, rows bigint, block binary"


def _blocks(p: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = Moments(np.zeros((4, p, p))), 0
        for batch in batches:
            if batch.num_rows:
                x = np.stack([c.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                total, rows = total.merge(Moments.of_rows(x)), rows + len(x)
        if rows:
            yield pa.RecordBatch.from_pydict({"rows": [rows], "block": [total.packed()]}, pa.schema([("rows", pa.int64()), ("block", pa.binary())]))
    return run


def _merge(tables: Iterator[pa.RecordBatch], p: int) -> tuple[int, Moments]:
    total, rows = Moments(np.zeros((4, p, p))), 0
    for batch in tables:
        for n, block in zip(batch.column("rows").to_pylist(), batch.column("block").to_pylist()):
            total, rows = total.merge(Moments.unpacked(block, p)), rows + n
    return rows, total


def comoments(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """One row per ordered pair of columns, by position: i, j, rows, n, mean_i, mean_j, sq_i, sq_j, cross.

    ``rows`` counts all rows, ``n`` those where both columns are present (NaN is not).
    An empty input gives no rows.
    """
    p = len(columns)
    numbers = df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def merged(table: pa.Table) -> pa.Table:
        rows, total = _merge(table.to_batches(), p)
        return pa.table({"part": pa.array([table.column("group")[0].as_py()]), "rows": pa.array([rows]), "block": pa.array([total.packed()])})

    def cells(table: pa.Table) -> pa.Table:
        rows, m = _merge(table.to_batches(), p)
        i, j = np.divmod(np.arange(p * p), p)
        own = {"i": i.astype(np.int32), "j": j.astype(np.int32), "rows": np.full(p * p, rows), "n": m.n.astype(np.int64).ravel(),
               "mean_i": m.mean.ravel(), "mean_j": m.mean.T.ravel(), "sq_i": m.sq.ravel(), "sq_j": m.sq.T.ravel(), "cross": m.cross.ravel()}
        return pa.table({k: pa.array(v) for k, v in own.items()})

    blocks = materialize(numbers.mapInArrow(_blocks(p), "rows bigint, block binary")
                         .withColumn("part", F.monotonically_increasing_id()), "moments")
    many = blocks.count()
    while many > FAN:
        groups = -(-many // FAN)
        blocks = materialize(blocks.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups))).groupBy("group")
                             .applyInArrow(merged, _BLOCK), "moments")
        many = groups
    return blocks.groupBy(F.lit(0).alias("group")).applyInArrow(
        cells, "i int, j int, rows bigint, n bigint, mean_i double, mean_j double, sq_i double, sq_j double, cross double")


def pair_counts(df: DataFrame, columns: Sequence[Column], bins: int) -> DataFrame:
    """(i, j, bin_i, bin_j, n) for the column positions i < j: rows by the bins (0 to ``bins`` - 1, or null) of two columns."""
    p = len(columns)
    pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(pairs), bins * bins), np.int64)
        for batch in batches:
            at = [c.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            whole = [bool((a >= 0).all()) for a in at]
            for k, (i, j) in enumerate(pairs):
                cell = at[i] * bins + at[j]
                if not (whole[i] and whole[j]):
                    cell = cell[(at[i] >= 0) & (at[j] >= 0)]
                total[k] += np.bincount(cell, minlength=bins * bins)
        k, cell = np.nonzero(total)
        pair = np.array(pairs, np.int32).reshape(-1, 2)[k]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            pair[:, 0], pair[:, 1], (cell // bins).astype(np.int32), (cell % bins).astype(np.int32), total[k, cell])],
            ["i", "j", "bin_i", "bin_j", "n"])

    binned = df.select(*[c.cast("int").alias(f"b{i}") for i, c in enumerate(columns)])
    return (binned.mapInArrow(count, "i int, j int, bin_i int, bin_j int, n bigint")
            .groupBy("i", "j", "bin_i", "bin_j").agg(F.sum("n").alias("n")))
