"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp): every vertex of ``edges`` with the smallest id of its component.

    Each round a vertex takes the smallest label among its own and its
    neighbours', then the label of its label; each round's labels are written
    as a table, so lineage stays short.  Many vertices may have one label: it is looked
    up by a join of two stored tables, which Spark can split.  The number of rounds grows
    with the logarithm of the longest chain.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = stored(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    labels = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label")), "cc-labels")
    while True:
        seen = (both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("near")), "v")
                .groupBy("u").agg(F.min("near").alias("near")))
        step = stored(labels.join(seen, "u").select("u", F.col("label").alias("old"), F.least("label", "near").alias("label")), "cc-step")
        jump = step.select(F.col("u").alias("label"), F.col("label").alias("far"))
        after = stored(step.join(jump, "label", "left")
                       .select("u", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "cc-labels")
        if after.where("label <> old").limit(1).count() == 0:
            return after.select(F.col("u").alias("id"), F.col("label").alias("comp"))
        labels = after.select("u", "label")
