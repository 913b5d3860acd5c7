"""PD7 diagonal: kernel density of columns from binned values.

Each value is split linearly between the two grid points around it, so a scan leaves one
weight per column and grid point whatever the number of rows; the weights are then
convolved with a Gaussian.  The bandwidth is R's rule of thumb (``bw.nrd0``): 0.9 times
the smaller of the standard deviation and the quartile distance over 1.34 -- the larger
where that is zero -- times n to the power -1/5.  The grid runs from the column's smallest
to its largest value, as the plot's does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.operators.quantiles import quantile_columns
from insight.sources.checkpoint import materialize

POINTS = 512


def density(df: DataFrame, columns: Sequence[str], points: int = POINTS) -> DataFrame:
    """``(var, point, x, density)``: ``points`` grid points per column.

    Nulls, NaN and infinities are left out.  A column without two different values has no
    bandwidth and gives no rows.
    """
    cols = list(columns)
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("var"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols])))
    long = materialize(long.where(F.abs("v") < F.lit(math.inf)), "density-values")
    spread = long.groupBy("var").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    hinges = quantile_columns(long, "var", "v", [0.25, 0.75], ["q1", "q3"]).drop("n")
    scale = F.least("sd", (F.col("q3") - F.col("q1")) / 1.34)
    width = 0.9 * F.when(scale > 0, scale).otherwise(F.col("sd")) * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    stats = materialize(spread.join(hinges, "var").where("hi > lo").select(
        "var", "n", "lo", ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"), width.alias("width")), "density-stats")
    at = long.join(stats.select("var", "lo", "step"), "var").withColumn("u", (F.col("v") - F.col("lo")) / F.col("step"))
    cell = F.least(F.floor("u"), F.lit(points - 2)).cast("int")
    cells = at.select("var", cell.alias("cell"), (F.col("u") - cell).alias("part")).groupBy("var", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("part").alias("right"))
    ends = F.array(F.struct(F.col("cell").alias("cell"), (F.col("n") - F.col("right")).alias("w")),
                   F.struct((F.col("cell") + 1).alias("cell"), F.col("right").alias("w")))
    weights = materialize(cells.select("var", F.inline(ends)).groupBy("var", "cell").agg(F.sum("w").alias("w")), "density-weights")
    z = (F.col("point") - F.col("cell")) * F.col("step") / F.col("width")
    spots = weights.join(stats, "var").withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    height = F.sum(F.col("w") * F.exp(-0.5 * z * z)) / (F.first("n") * F.first("width") * math.sqrt(2 * math.pi))
    return spots.groupBy("var", "point").agg((F.first("lo") + F.col("point") * F.first("step")).alias("x"), height.alias("density"))
