"""Queries of the training-data operators: ``name -> (spark, sf_dir) -> DataFrame`` and DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.llm import (decontaminate, divergence, jaccard, langid, licenses, mixing, ppm, prefixtrie, quality, repeats, rules,
                         toxicity, urlrules)
from insight.llm.common import held_out
from insight.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op2_source_mix", mixing.MIX_SQL)
def op2_source_mix(spark, sf_dir):
    return mixing.mix_plan(read_table(spark, sf_dir, "documents"))


@register("op8_url_rules")
def op8_url_rules(spark, sf_dir):
    return urlrules.judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


@register("op9_license_scan", licenses.SCAN_SQL)
def op9_license_scan(spark, sf_dir):
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


@register("op1_quality_resample")
def op1_quality_resample(spark, sf_dir):
    return quality.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op10_quality_rules")
def op10_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))).drop("score")


@register("op5_benchmark_hits", decontaminate.HITS_SQL)
def op5_benchmark_hits(spark, sf_dir):
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op4_near_duplicates")
def op4_near_duplicates(spark, sf_dir):
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


@register("op7_ppm_score")
def op7_ppm_score(spark, sf_dir):
    return ppm.score_texts(read_table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 1))


@register("op3_language_id")
def op3_language_id(spark, sf_dir):
    return langid.identify(read_table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0))


@register("op6_toxic_spans")
def op6_toxic_spans(spark, sf_dir):
    scored = toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                     held_out(F.col("doc_id"), 3, 1))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans")


@register("op11_repeated_spans", repeats.REMOVED_SQL)
def op11_repeated_spans(spark, sf_dir):
    return repeats.removed_words(read_table(spark, sf_dir, "documents"))


@register("op12_source_audit", divergence.AUDIT_SQL)
def op12_source_audit(spark, sf_dir):
    return divergence.audit(read_table(spark, sf_dir, "documents"))


@register("op13_prefix_trie", prefixtrie.TRIE_SQL)
def op13_prefix_trie(spark, sf_dir):
    return prefixtrie.prefix_trie(*prefixtrie.rebuild(read_table(spark, sf_dir, "conversations")))
