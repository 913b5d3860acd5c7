"""Column profiling in long form.

R returns per-column results as named vectors or ragged lists; here every
profile is a long DataFrame ``(column, ...)`` built from ONE aggregation
job (a wide one-row aggregate exploded into rows), or from an unpivot
followed by a distributed ``distinct`` / filter.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from insight.functions.nulls import is_na

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)
DATED = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _field(df: DataFrame, name: str) -> T.StructField:
    return next(f for f in df.schema.fields if f.name == name)


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(_field(df, name).dataType, NUMERIC)


def _na(df: DataFrame, name: str) -> Column:
    return is_na(_q(name), isinstance(_field(df, name).dataType, FLOATING))


def _explode_rows(wide: DataFrame, rows: list[Column]) -> DataFrame:
    return wide.select(F.explode(F.array(*rows)).alias("__r")).select("__r.*")


def dims(df: DataFrame) -> DataFrame:
    """EX3: ``dim()`` as one row ``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def structure(df: DataFrame, key: str | Sequence[str], k: int = 5) -> DataFrame:
    """EX5: ``str()``/``glimpse()``: name, type and the first ``k`` values by key."""
    keys = [key] if isinstance(key, str) else list(key)
    head = df.orderBy(*keys).limit(k)
    ordered = F.struct(*[_q(c) for c in keys])
    rows, aggs = [], []
    for i, f in enumerate(df.schema.fields):
        aggs.append(F.sort_array(F.collect_list(F.struct(ordered.alias("k"),
                                                         _q(f.name).cast("string").alias("v"))))
                    .alias(f"s{i}"))
        rows.append(F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                             F.lit(f.dataType.simpleString()).alias("type"),
                             F.transform(F.col(f"s{i}"), lambda x: x["v"]).alias("first_values")))
    return _explode_rows(head.agg(*aggs), rows)


def na_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """EX11: ``sapply(df, function(y) sum(is.na(y)))`` as ``(column, n_na)``.

    NaN counts as NA on floating columns, as ``is.na`` does.
    """
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(_na(df, c)).alias(f"n{i}") for i, c in enumerate(cols)])
    return _explode_rows(wide, [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_na"))
                                for i, c in enumerate(cols)])


def na_positions(df: DataFrame, key: str, columns: Sequence[str] | None = None,
                 row_numbers: bool = False) -> DataFrame:
    """EX10: ``apply(is.na(df), 2, which)`` as ``(column, key)`` rows, one per NA cell.

    With ``row_numbers=True`` a ``row`` column holds R's 1-based row number
    in key order, computed by :func:`insight.operators.ranking.row_positions`
    (range partitions and per-partition offsets, no single-task sort).
    """
    cols = [c for c in (columns or df.columns) if c != key]
    src = df
    extra = []
    if row_numbers:
        from insight.operators.ranking import row_positions
        src = row_positions(df, key, "row")
        extra = ["row"]
    cells = F.array(*[F.when(_na(df, c), F.lit(c)) for c in cols])
    return (src.select(_q(key), *extra, F.explode(cells).alias("column"))
            .filter(F.col("column").isNotNull())
            .select("column", key, *extra))


def column_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """EX6: ``summary()``: a row per column with its ``kind``.

    Numeric columns: min, exact type-7 quartiles, mean, max and NA count, with
    NAs (and NaN) left out of the statistics, as R's summary does.  Date and
    timestamp columns: the same, as seconds since 1970.  Other columns: length
    (``n``), as R reports character columns, and NA count; nulls elsewhere.
    """
    from insight.operators.quantiles import quantile_columns

    cols = list(columns or df.columns)
    dated = {c: isinstance(_field(df, c).dataType, DATED) for c in cols}
    measured = [c for c in cols if is_numeric(df, c) or dated[c]]
    value = {c: F.unix_micros(_q(c).cast("timestamp")) / F.lit(1e6) if dated[c] else _q(c).cast("double")
             for c in measured}
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    none = F.lit(None).cast("double")
    for i, c in enumerate(cols):
        aggs.append(F.count_if(_na(df, c)).alias(f"na{i}"))
        stats = [none.alias("min"), none.alias("mean"), none.alias("max")]
        if c in value:
            x = F.when(~_na(df, c), value[c])
            aggs += [F.min(x).alias(f"min{i}"), F.avg(x).alias(f"mean{i}"), F.max(x).alias(f"max{i}")]
            stats = [F.col(f"{s}{i}").alias(s) for s in ("min", "mean", "max")]
        kind = "date" if dated[c] else "numeric" if c in value else "text"
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col("n"), *stats,
                             F.col(f"na{i}").alias("n_na")))
    simple = _explode_rows(df.agg(*aggs), rows)
    out = ["column", "kind", "n", "min", "q1", "median", "mean", "q3", "max", "n_na"]
    if not measured:
        return simple.select(*[F.col(c) if c in simple.columns else none.alias(c) for c in out])
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.when(~_na(df, c), value[c]).alias("value"))
        for c in measured])).alias("__c")).select("__c.*")
    quart = quantile_columns(long, ["column"], "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    return simple.join(quart.drop("n"), "column", "left").select(*out)


def column_mean_sd(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """EX14/EX15: ``sapply(df, mean)`` and ``sapply(df, sd)``.

    A non-numeric column gives NA (null); one NA in a column makes its mean
    and sd NA (no ``na.rm``).
    """
    cols = list(columns or df.columns)
    n_all = F.count(F.lit(1))
    aggs, rows = [], []
    for i, c in enumerate(cols):
        if is_numeric(df, c):
            x = _q(c).cast("double")
            full = F.count(x) == n_all
            aggs += [F.when(full, F.avg(x)).alias(f"m{i}"), F.when(full, F.stddev_samp(x)).alias(f"s{i}")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"m{i}"), F.lit(None).cast("double").alias(f"s{i}")]
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"),
                             F.col(f"s{i}").alias("sd")))
    return _explode_rows(df.agg(*aggs), rows)


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """EX12: ``sapply(df, unique)`` as ``(column, value)``; values as text, NA kept as null.

    Unpivot then a distributed ``distinct`` (partial aggregation per task).
    """
    cols = list(columns or df.columns)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("value")) for c in cols
    ])).alias("__c")).select("__c.*")
    return long.distinct()


#: Distinct values up to which a column's are listed.
MOST_LEVELS = 1000


def column_levels(df: DataFrame, columns: Sequence[str] | None = None, most: int = MOST_LEVELS) -> DataFrame:
    """EX12 with a guard: ``(column, n_levels, listed, value)``.

    ``n_levels`` is a HyperLogLog estimate (one sketch per column, one aggregate).
    Columns of at most ``most`` levels have a row per value, NA included; the others have
    one row with a null value and ``listed`` false.  :func:`distinct_values` lists all.
    """
    from insight.sources.checkpoint import materialize
    cols = list(columns or df.columns)
    sketches = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(_q(c).cast("string"))).alias(f"n{i}") for i, c in enumerate(cols)])
    sizes = _explode_rows(sketches, [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("n_levels"))
                                     for i, c in enumerate(cols)]).withColumn("listed", F.col("n_levels") <= most)
    sizes = materialize(sizes, "levels")
    few = [r["column"] for r in sizes.where("listed").select("column").collect()]  # column names
    long = sizes.where("NOT listed").withColumn("value", F.lit(None).cast("string"))
    if not few:
        return long
    return sizes.join(distinct_values(df, few), "column").select(long.columns).unionByName(long)


def first_seen_levels(df: DataFrame, column: str, key: str) -> DataFrame:
    """EX13: distinct values of one column in order of first appearance
    (``unique()``): ``(value, first_key, level)`` with a 1-based level.

    Levels are numbered by :func:`insight.operators.ranking.row_positions`
    (no single-task sort, whatever the number of distinct values)."""
    from insight.operators.ranking import row_positions
    firsts = df.groupBy(_q(column).alias("value")).agg(F.min(_q(key)).alias("first_key"))
    return row_positions(firsts, "first_key", "level").withColumn("level", F.col("level").cast("int"))


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    """EX16: ``filter(...) %>% nrow()``: the filter can reach the scan, the count is one row."""
    return df.filter(condition).agg(F.count(F.lit(1)).alias(name))


def apply_per_column(df: DataFrame, fn: Callable[[Column], Column],
                     columns: Sequence[str] | None = None, name: str = "value") -> DataFrame:
    """UF1: ``sapply(df, function(y) ...)`` for an aggregate-valued ``fn``:
    ``(column, value)`` from one aggregation job."""
    cols = list(columns or df.columns)
    wide = df.agg(*[fn(_q(c)).alias(f"v{i}") for i, c in enumerate(cols)])
    return _explode_rows(wide, [F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias(name))
                                for i, c in enumerate(cols)])
