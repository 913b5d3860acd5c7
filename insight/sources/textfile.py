"""Text-line hand-off: one record per line, blank lines kept; row numbers in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from insight.sources.checkpoint import materialize


def in_file_order(df: DataFrame, name: str = "row") -> DataFrame:
    """Rows read from files (``df`` as the reader returns it) with their 1-based number in file order.

    Files count in the order of their paths.  Spark cuts files in blocks and deals the
    blocks to tasks by size, but the rows of a block stay together and in order.  So a
    row's number is its place in its block plus the rows of all blocks before it, in the
    order of (file, block start): one row per block becomes an offset, no row is sorted.
    """
    rows = materialize(df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
                                 F.monotonically_increasing_id().alias("__id")), "file-rows")
    blocks = rows.groupBy("__file", "__block").agg(F.min("__id").alias("__lo"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file", "__block")) - F.col("__n")
    offsets = blocks.select("__file", "__block", (before - F.col("__lo") + 1).alias("__off"))
    return (rows.join(offsets, ["__file", "__block"]).withColumn(name, F.col("__id") + F.col("__off"))
            .drop("__file", "__block", "__id", "__off"))


def read_numbered_lines(spark: SparkSession, path: str, row: str = "row", text: str = "text") -> DataFrame:
    """Text files as ``(row, text)``, lines numbered 1..n over all files."""
    return in_file_order(spark.read.text(path), row).select(row, F.col("value").alias(text))


def read_lines(spark: SparkSession, path: str, key: str = "line_id",
               text: str = "text") -> DataFrame:
    """Read text files as ``(line_id, file, text)``.

    ``line_id`` is unique and rises with the position within a file.  Spark
    deals files to tasks by size, so it does not order lines of different
    files: sort by ``(file, line_id)``.
    """
    df = spark.read.text(path)
    return df.select(
        F.monotonically_increasing_id().alias(key),
        F.col("_metadata.file_path").alias("file"),
        F.col("value").alias(text),
    )


def write_lines(df: DataFrame, path: str, text: str = "text", mode: str = "overwrite") -> None:
    """Write one column as text lines (a directory of part files)."""
    df.select(F.col(text).cast("string")).write.mode(mode).text(path)
