"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nsjoin(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` treating null keys as equal (an NA group is a group)."""
    if not keys:
        raise ValueError("nsjoin needs keys")
    r = right.select(*[F.col(c).alias(f"__rk_{i}") if c in keys else F.col(c)
                       for i, c in enumerate(right.columns)])
    renamed = {c: f"__rk_{right.columns.index(c)}" for c in keys}
    cond = None
    for c in keys:
        e = left[c].eqNullSafe(r[renamed[c]])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*renamed.values())
