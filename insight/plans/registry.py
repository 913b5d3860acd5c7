"""Registry of named queries: ``name -> (spark plan, oracle SQL)``.

Each plan takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  The oracle SQL is DuckDB SQL over the same tables
(pre-registered views) producing the same column names; ``None`` marks a
query without an SQL form.

``rounded`` lists floating columns whose value depends on summation order;
both the plan and the SQL round them to ``digits`` places so the comparison
is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def _round_plan(fn: Plan, cols: Sequence[str], digits: int) -> Plan:
    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
    plan.__name__ = getattr(fn, "__name__", "plan")
    plan.__doc__ = fn.__doc__
    return plan


def _round_sql(sql: str, cols: Sequence[str], digits: int) -> str:
    repl = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n)"


def register(name: str, sql: str | None, rounded: Sequence[str] = (), digits: int = 6):
    def deco(fn: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = _round_plan(fn, rounded, digits) if rounded else fn
        if sql is not None:
            ORACLE[name] = _round_sql(sql, rounded, digits) if rounded else sql
        return fn
    return deco


def load_all() -> tuple[dict[str, Plan], dict[str, str]]:
    """Import the modules that register queries; return both maps."""
    from insight.plans import hotel_queries, profile_queries, text_queries  # noqa: F401
    return QUERIES, ORACLE
