"""URL filter from association rules.

Labelled pages become item sets of all their frequent URL tokens.  Tokens that stand on
exactly the same labelled pages are one item, so what always comes together is mined
once; FP-growth mines the combinations of items with the label, and the rules
``tokens -> label`` with enough support and confidence, and more confidence than any
rule of one token less, are kept.  A rule of items stands for all its choices of one
token from each item.  Items on all labelled pages are rules by themselves at most:
with them a combination stays as sure as without.

Rules are looked up by an inverted index: each is posted under its rarest item, and a
URL that has this item is tested for the others.

A page's label is that of the document whose number its URL path ends in (the
crawl's own numbering).  Numbers are not tokens, so rules do not learn single
pages.

Host rules: a fixed list of (host, path prefix) rules decides first; the
longest that fits wins.

Edge cases: a null url, or one without ``://``, has an empty host and path and
no tokens; without labelled pages, or with none that pass the bounds, no rule
holds and the default verdict is ``allow``; repeated rows are judged alike.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import lower_ascii, stored

#: Fixed values: (verdict, host, path prefix).
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_SUPPORT = 0.002
MIN_COUNT = 10
MIN_CONFIDENCE = 0.5
#: The item of a bad page; tokens have a colon.
BAD = "bad"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host, up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: Column, path: Column, rules=HOST_RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest host rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels by level, path words by depth, suffix, query keys and values.

    Pure numbers are left out.
    """
    host, path = host_of(url), path_of(url)
    scheme = F.concat(F.lit("s:"), lower_ascii(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))
    labels = F.reverse(F.split(host, r"\."))
    hosts = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    parts = F.transform(F.split(path, "/"), lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), lower_ascii(x)))
    parts = F.filter(parts, lambda x: ~x.rlike(r"^p\d+:\d*(\.[a-z0-9]+)?$"))
    suffix = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    extra = F.array(F.when(suffix != "", F.concat(F.lit("x:"), lower_ascii(suffix))),
                    F.when(F.regexp_extract(url, r"#(.+)$", 1) != "", F.lit("f:")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), lower_ascii(x))),
                     lambda x: x != "q:")
    tokens = F.array_compact(F.concat(F.array(scheme), hosts, parts, extra, pairs))
    return F.when(url.contains("://"), F.array_distinct(tokens)).otherwise(F.array().cast("array<string>"))


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """tokens, bad: pages whose URL path ends in the number of a labelled document."""
    number = F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1)
    numbered = pages.select(url_tokens(F.col("url")).alias("tokens"),
                            F.when(number != "", number.cast("long")).alias("doc_id"))
    bad = ((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).cast("int")
    marks = (labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
             .groupBy("doc_id").agg(F.max(bad).alias("bad")))
    return numbered.where(F.col("doc_id").isNotNull()).join(marks, "doc_id").select("tokens", "bad")


def token_items(labelled: DataFrame, least: int) -> DataFrame:
    """(token, item, n): tokens of at least ``least`` bad pages; those of the same pages have the same item.

    ``labelled`` has page, tokens and bad.  Sets of pages are compared by their size and
    two exclusive ors of page hashes.
    """
    pages = [F.bit_xor(F.xxhash64(F.lit(i), "page")).alias(f"h{i}") for i in range(2)]
    tokens = (labelled.select("page", "bad", F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), *pages).where(F.col("bad") >= least).drop("bad"))
    tokens = stored(tokens, "url-tokens")
    same = ["n", "h0", "h1"]
    return tokens.join(tokens.groupBy(*same).agg(F.min("token").alias("item")), same).select("token", "item", "n")


def mine_items(labelled: DataFrame, min_support: float, min_count: int, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """Items (token, item, n) and rules (items, n, confidence) of ``labelled`` pages (tokens, bad)."""
    labelled = stored(labelled.select("tokens", "bad", F.monotonically_increasing_id().alias("page")), "url-labelled")
    total, all_bad = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    least = math.ceil(max(min_support * total, min_count))
    items = stored(token_items(labelled, least), "url-items")
    single = items.where(F.col("n") == total).select(F.array("item").alias("items"), "n", F.lit(all_bad).cast("long").alias("bad")).distinct()
    mined = items.where(F.col("n") < total)
    sets = (labelled.select("page", "bad", F.explode("tokens").alias("token")).join(mined.select("token", "item"), "token")
            .groupBy("page").agg(F.collect_set("item").alias("items"), F.max("bad").alias("bad"))
            .select(F.when(F.col("bad") == 1, F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")))
    sets = stored(sets, "url-sets")
    many = sets.count()
    if many >= least:
        growth = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / many, minConfidence=1.0)
        found = stored(growth.fit(sets).freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n")), "url-sets-found")
        with_label = found.where(F.array_contains("items", BAD)).select(F.array_remove("items", F.lit(BAD)).alias("items"), F.col("n").alias("bad"))
        single = single.unionByName(found.join(with_label.where(F.size("items") > 0), "items").select("items", "n", "bad"))
    rules = (single.withColumn("confidence", F.col("bad") / F.col("n"))
             .where((F.col("bad") >= least) & (F.col("confidence") >= min_confidence)).drop("bad"))
    rules = stored(rules, "url-rules")
    parts = (rules.where(F.size("items") > 1)
             .select("items", "confidence", F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("part")))
    smaller = rules.select(F.col("items").alias("part"), F.col("confidence").alias("sure"))
    repeats = parts.join(smaller, "part").where(F.col("sure") >= F.col("confidence")).select("items")
    return items, stored(rules.join(repeats.distinct(), "items", "left_anti"), "url-rules-kept")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
               min_confidence: float = MIN_CONFIDENCE) -> list[dict]:
    """Rules ``tokens -> bad`` written out, for reading: tokens, count, confidence."""
    items, rules = mine_items(labelled, min_support, min_count, min_confidence)
    tokens: dict[str, list] = {}
    for r in items.join(rules.select(F.explode("items").alias("item")).distinct(), "item", "left_semi").collect():
        tokens.setdefault(r["item"], []).append(r["token"])
    out = [{"tokens": sorted(chosen), "count": r["n"], "confidence": r["confidence"]}
           for r in rules.collect() for chosen in product(*(tokens[i] for i in r["items"]))]
    return sorted(out, key=lambda r: r["tokens"])


def rule_confidence(urls: DataFrame, items: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence): the highest confidence of the rules that fit, for the URLs that any fits."""
    needed = rules.select(F.explode("items").alias("item")).distinct()
    used = items.join(needed, "item", "left_semi")
    have = (urls.where(F.col("url").isNotNull()).select("url").distinct()
            .select("url", F.explode(url_tokens(F.col("url"))).alias("token")).join(used.select("token", "item"), "token")
            .groupBy("url").agg(F.collect_set("item").alias("have")))
    sizes = used.select("item", "n").distinct().withColumnRenamed("n", "pages")
    posted = (rules.select("items", "confidence", F.explode("items").alias("item")).join(sizes, "item")
              .groupBy("items", "confidence").agg(F.min_by("item", F.struct("pages", "item")).alias("item")))
    return (have.select("url", "have", F.explode("have").alias("item")).join(posted, "item")
            .where(F.size(F.array_except("items", "have")) == 0).groupBy("url").agg(F.max("confidence").alias("confidence")))


def judge_urls(pages: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence for every row of ``pages``."""
    limits = {"min_support": MIN_SUPPORT, "min_count": MIN_COUNT, "min_confidence": MIN_CONFIDENCE} | bounds
    items, rules = mine_items(page_labels(pages, labels), **limits)
    url = F.col("url")
    sure = rule_confidence(pages, items, rules)
    base = pages.select("page_id", "url").join(sure, "url", "left")
    rule, verdict = host_rule(F.col("host"), F.col("path"))
    out = base.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    mined = F.when(F.col("confidence") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "confidence")
