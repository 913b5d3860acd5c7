"""IO6, IO7 for repeated searches: a stored index of the words of a collection.

A row is a term and a block, a block being ``BLOCK`` consecutive ids: the smallest and
largest id, their number and the ids' places in the block, ascending; Parquet stores these
lists delta-coded.  The rows are written in the order of term and block, so a search reads
the row groups of its terms alone; blocks that not all terms have, or whose id ranges do
not meet, are left out before any list is compared.  New documents are appended as further
rows (:func:`append_index`); ids are not to come twice.

A very common term has a row per block, so no task holds more than ``BLOCK`` ids of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS
DELTA_CODED = {"parquet.writer.version": "v2", "parquet.enable.dictionary#places.list.element": "false"}


def words(text: Column) -> Column:
    """Distinct ASCII words, lower-cased: what :func:`insight.functions.text.contains_word` finds whole."""
    return F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+")), "")


def postings(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(term, block, low, high, n, places): the ids of each term, by block."""
    pairs = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.explode(words(text)).alias("term"))
    place = F.col("id").bitwiseAND(F.lit(BLOCK - 1)).cast("int")
    return pairs.groupBy("term", F.shiftright("id", BLOCK_BITS).alias("block")).agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(place)).alias("places"))


def write_index(docs: DataFrame, key: str, text: Column, path: str, mode: str = "error") -> None:
    """Store the index of ``docs`` under ``path``."""
    rows = postings(docs, key, text).repartitionByRange("term", "block").sortWithinPartitions("term", "block")
    rows.write.mode(mode).options(**DELTA_CODED).parquet(path)


def append_index(docs: DataFrame, key: str, text: Column, path: str) -> None:
    """Add documents to a stored index."""
    write_index(docs, key, text, path, "append")


def search_index(spark: SparkSession, path: str, terms: Sequence[str], key: str = "id") -> DataFrame:
    """The ids (``key``) of the documents that hold every term (one ASCII word each, any case)."""
    asked = sorted({t.lower() for t in terms})
    rows = spark.read.parquet(path).where(F.col("term").isin(asked))
    # appended rows of a block are read as one
    full = rows.groupBy("block", "term").agg(F.min("low").alias("low"), F.max("high").alias("high")).groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.max("low").alias("from"), F.min("high").alias("to"))
    full = full.where((F.col("n") == len(asked)) & (F.col("from") <= F.col("to"))).select("block")
    lists = (rows.join(full, "block").groupBy("block", "term").agg(F.flatten(F.collect_list("places")).alias("places"))
             .groupBy("block").agg(F.collect_list("places").alias("lists")))
    common = F.aggregate(F.slice("lists", 2, max(1, len(asked))), F.element_at("lists", 1), lambda a, b: F.array_intersect(a, b))
    return lists.select("block", F.explode(common).alias("place")).select((F.shiftleft("block", BLOCK_BITS) + F.col("place")).alias(key))
