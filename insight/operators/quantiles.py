"""Exact type-7 quantiles by bracketed selection: two scans, no sort of the input.

1. A mergeable KLL sketch per group (partial aggregation, a few KB whatever the
   group's size) brackets each wanted rank by two values, ``ERROR`` of the ranks
   to either side.
2. A second scan counts, per group, the values below each bracket and keeps only
   the values inside one, equal ones counted together (one aggregate does both).
3. The kept values are cumulated and the rows that cover the ranks are taken.

The sketch only chooses what is kept; ranks are counted exactly.  A bracket that
misses its rank -- rare, the sketch is random -- is widened to the group's ends
and counted anew.  Where a bracket still holds over ``KEPT`` distinct values, they
are cut at quantiles of a sketch of their own and the piece that holds the ranks
goes on, so no task cumulates more than that.

For a probability ``p`` the ranks are ``floor(h)`` and ``ceil(h)`` with
``h = (n - 1) p`` (R type 7 / ``quantile_cont``).  Infinities are ordinary values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insight.operators.joins import nsjoin
from insight.sources.checkpoint import materialize

#: Sketch size: a rank is off by 0.3 % of the rows with probability 0.01.
SKETCH = 1000
#: Ranks that a bracket reaches to either side, as a share of the rows.
ERROR = 0.008
#: A group of fewer rows is kept whole: ranks are further apart than the bracket is wide.
SMALL = 500
#: Distinct values that are cumulated at once; pieces that more of them are cut in.
KEPT, PIECES = 1 << 20, 64


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _rank(n: Column, p: float, up: bool) -> Column:
    h = (n - 1) * F.lit(float(p))
    return (F.ceil(h) if up else F.floor(h)).cast("bigint")


def _sketch_at(rank: float) -> Column:
    return F.kll_sketch_get_quantile_double("__s", F.lit(min(1.0, max(0.0, rank))))


def _brackets(values: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Per group: ``n`` and, for each probability, ``__lo`` and ``__hi``."""
    sketches = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__v", F.lit(SKETCH)).alias("__s"))
    whole, ends = F.col("n") < SMALL, []
    for i, p in enumerate(probs):
        ends += [F.when(whole, F.lit(float("-inf"))).otherwise(_sketch_at(p - ERROR)).alias(f"__lo{i}"),
                 F.when(whole, F.lit(float("inf"))).otherwise(_sketch_at(p + ERROR)).alias(f"__hi{i}")]
    return materialize(sketches.select(*keys, "n", *ends), "quantile-brackets")


def _near(values: DataFrame, brackets: DataFrame, keys: list[str], many: int) -> DataFrame:
    """Counts by group, value inside a bracket (else null) and set of the brackets that lie above (bits)."""
    inside = F.lit(False)
    above = F.lit(0)
    for i in range(many):
        inside = inside | F.col("__v").between(F.col(f"__lo{i}"), F.col(f"__hi{i}"))
        above = above + F.when(F.col("__v") < F.col(f"__lo{i}"), F.lit(1 << i)).otherwise(F.lit(0))
    rows = nsjoin(values, brackets.drop("n"), keys).select(
        *keys, F.when(inside, F.col("__v")).alias("__x"), above.alias("__above"))
    return materialize(rows.groupBy(*keys, "__x", "__above").agg(F.count(F.lit(1)).alias("__c")), "quantile-near")


def _candidates(near: DataFrame, brackets: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """(keys, p, n, r_lo, r_hi, below, x, c): the kept values of each bracket and how many values lie below it."""
    below = near.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(F.col("__above").bitwiseAND(F.lit(1 << i)) != 0, F.col("__c"))), F.lit(0))
                                      .alias(f"__b{i}") for i in range(len(probs))])
    full = nsjoin(nsjoin(near.where("__x IS NOT NULL").drop("__above"), brackets, keys), below, keys)
    ranks = F.array(*[F.struct(F.lit(float(p)).alias("p"), _rank(F.col("n"), p, False).alias("r_lo"), _rank(F.col("n"), p, True).alias("r_hi"),
                               F.col(f"__b{i}").alias("below"), F.col("__x").between(F.col(f"__lo{i}"), F.col(f"__hi{i}")).alias("own"))
                      for i, p in enumerate(probs)])
    return (full.select(*keys, "n", F.col("__x").alias("x"), F.col("__c").alias("c"), F.inline(ranks)).where("own").drop("own"))


def _narrowed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The candidates of the pieces that hold the ranks; ``below`` grows by what lies before them."""
    by = [*keys, "p"]
    splits = rows.groupBy(*by).agg(F.kll_sketch_agg_double("x", F.lit(SKETCH)).alias("__s")).select(
        *by, F.array(*[_sketch_at(j / PIECES) for j in range(1, PIECES)]).alias("__splits"))
    cut = nsjoin(rows, splits, by).withColumn("__piece", F.size(F.filter("__splits", lambda s: s < F.col("x")))).drop("__splits")
    cut = materialize(cut, "quantile-pieces")
    sums = cut.groupBy(*by, "__piece").agg(F.sum("c").alias("__sum"), F.first("below").alias("__under"), F.first("r_lo").alias("__r_lo"),
                                           F.first("r_hi").alias("__r_hi"))
    upto = F.sum("__sum").over(Window.partitionBy(*by).orderBy("__piece"))
    before = F.col("__under") + upto - F.col("__sum")
    held = (sums.withColumn("__before", before).where((F.col("__r_hi") >= F.col("__before")) & (F.col("__r_lo") < F.col("__before") + F.col("__sum")))
            .select(*by, "__piece", "__before"))
    first = Window.partitionBy(*by)
    held = held.withColumn("__before", F.min("__before").over(first))
    kept = nsjoin(cut, held, [*by, "__piece"]).withColumn("below", F.col("__before")).drop("__before", "__piece")
    return materialize(kept, "quantile-kept")


def exact_quantiles(df: DataFrame, by: str | Sequence[str] | None, value: str,
                    probs: Sequence[float]) -> DataFrame:
    """``(by..., p, q, n)``: type-7 quantile ``q`` of ``value`` for each ``p``.

    Nulls and NaN are left out; a group with no values gives no rows.
    """
    out_keys = _keys(by)
    keys = out_keys or ["__g"]
    probs = list(dict.fromkeys(float(p) for p in probs))
    src = df if out_keys else df.withColumn("__g", F.lit(0))
    values = src.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    brackets = _brackets(values, keys, probs)
    while True:
        near = _near(values, brackets, keys, len(probs))
        rows = _candidates(near, brackets, keys, probs)
        per = rows.groupBy(*keys, "p").agg(F.count(F.lit(1)).alias("__rows"), F.sum("c").alias("__sum"), F.first("below").alias("__below"),
                                           F.first("r_lo").alias("__r_lo"), F.first("r_hi").alias("__r_hi"))
        missed = (F.col("__r_lo") < F.col("__below")) | (F.col("__r_hi") >= F.col("__below") + F.col("__sum"))
        most, misses, found = per.agg(F.max("__rows"), F.count_if(missed), F.count(F.lit(1))).first()
        if not misses and found == len(probs) * brackets.count():
            break
        ends = {f"__{side}{i}": F.lit(float(sign + "inf")) for i in range(len(probs)) for side, sign in (("lo", "-"), ("hi", ""))}
        brackets = materialize(brackets.withColumns(ends), "quantile-brackets")
    while most and most > KEPT:
        rows, last = _narrowed(rows, keys), most
        most = rows.groupBy(*keys, "p").count().agg(F.max("count")).first()[0]
        if most >= last:
            break
    upto = F.col("below") + F.sum("c").over(Window.partitionBy(*keys, "p").orderBy("x"))
    ranked = rows.withColumn("__upto", upto)

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) < F.col("__upto")) & (F.col(rank) >= F.col("__upto") - F.col("c")), F.col("x")))

    out = ranked.groupBy(*keys, "p").agg(F.first("n").alias("n"), at("r_lo").alias("x_lo"), at("r_hi").alias("x_hi"))
    h = (F.col("n") - 1) * F.col("p")
    # equal neighbours first: Inf - Inf is no difference
    q = (F.when(F.col("x_lo") == F.col("x_hi"), F.col("x_lo"))
         .otherwise(F.col("x_lo") + (h - F.floor(h)) * (F.col("x_hi") - F.col("x_lo"))))
    return out.select(*out_keys, "p", q.alias("q"), "n")


def quantile_columns(df: DataFrame, by: str | Sequence[str] | None, value: str,
                     probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Wide form: one column per probability (``names``), plus ``n``."""
    keys = _keys(by)
    long = exact_quantiles(df, keys, value, probs)
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(name) for p, name in zip(probs, names)]
    return long.groupBy(*keys).agg(*aggs, F.max("n").alias("n"))
