"""Corpus pipeline: five stages over ``documents``, one after the other.

Each stage's result is written as Parquet and read again as the next one's
input, so a lost executor never costs more than the running stage.  A stage
takes ``(spark, docs, sf_dir)``; models are fitted on the labelled rows of the
whole ``documents`` table and decide about every row of ``docs``.

All stages return the columns of ``docs``.  Edge cases are those of the
operators: a text without words (null and empty ones too) is no evidence of
quality and goes in the first stage that sees it; rows with equal doc_id are
documents of their own; extra columns are carried along; empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from insight.llm import decontaminate, jaccard, mixing, quality, rules
from insight.llm.common import stored
from insight.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the documents that importance resampling draws."""
    return quality.resampled(docs, read_table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the documents that the fixed rules and the boosted trees keep."""
    trees = rules.fit_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return rules.kept_rows(docs, trees)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each class of near duplicates."""
    return jaccard.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents without the benchmark's passages."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents repeated as the mix takes them."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: Several stages fit models, which SQL cannot express; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
