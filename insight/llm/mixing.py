"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target, and its repetition
rate is target / size.  A document is taken floor(rate) times, plus once more
with probability equal to the fraction, drawn from a hash of the seed, its doc_id, its
text and its number among equal rows, so reruns agree and rows that share an id, or have
none, are drawn one by one.

Targets: the sources, by code point with null last, weigh 3, 1, 2, repeating,
and share ``share`` times all tokens; no target exceeds ``most`` times its
source's size, and what is cut is shared again by weight among the others.

Edge cases: null and empty texts have size 0 (they are taken by the same
rule); rows equal in doc_id, text and source are numbered, in no given order; an empty
table gives an empty result; a source of size 0 has target 0 and rate 0; other columns
are ignored or, in :func:`mixed`, carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.common import maybe_in, stored, unit_hash, unused_name, words_of
from insight.operators.ranking import row_positions

#: Weights by position of the source, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"
#: Sources up to which the source table (under 100 bytes a row) is broadcast.
BROADCAST_SOURCES = 100_000


def _ranked(sources: DataFrame) -> DataFrame:
    """0-based position of each source by code point, null last, as ``pos``."""
    named = sources.where(F.col("source").isNotNull())
    after = sources.where(F.col("source").isNull()).crossJoin(F.broadcast(named.agg(F.count(F.lit(1)).alias("pos"))))
    numbered = row_positions(named, "source", "pos").withColumn("pos", F.col("pos") - 1)
    return numbered.unionByName(after)


def source_targets(sized: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target from rows of (source, size).

    The level of sharing rises round by round: sources whose share exceeds
    their bound are fixed at it, and the rest is shared again by weight.  Each
    round is one aggregate over the table of sources.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("pos") % len(WEIGHTS) + 1).cast("int"))
    sources = stored(sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "mix-sizes")
    sources = stored(_ranked(sources).withColumn("weight", weight), "mix-sources")
    cap = F.lit(most) * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        # a source is cut when its share at this level is above its bound
        cut = F.lit(level) * F.col("weight") > cap
        fixed, rest = sources.agg(F.coalesce(F.sum(F.when(cut, F.col("source_size"))), F.lit(0)),
                                  F.sum(F.when(~cut, F.col("weight")))).first()
        if not rest:
            break
        raised = (share * total - most * fixed) / rest
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap)).drop("pos", "weight")


def _with_targets(df: DataFrame, targets: DataFrame, source: str, names: dict[str, str]) -> DataFrame:
    """Join rows with their source's figures (null-safe); ``names`` renames those."""
    small = targets.select(F.col("source").alias("__src"), *[F.col(k).alias(v) for k, v in names.items()])
    on = df[source].eqNullSafe(F.col("__src"))
    if small.count() <= BROADCAST_SOURCES:
        return df.join(F.broadcast(small), on).drop("__src")
    # a source may hold a third of the rows: deal it over salts
    salts = 64
    dealt = df.withColumn("__salt", (F.rand(7) * salts).cast("int"))
    salted = small.withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(salted, on & (F.col("__salt") == F.col("__slot"))).drop("__src", "__salt", "__slot")


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with the 0-based number of each row among those of the same ``key``.

    Only rows whose key occurs again (and few others) move.  They are stored with their
    place; a key's rows are numbered inside each stored part, and the counts per part
    become offsets, so a key that holds a third of the rows is numbered in many tasks.
    """
    flag, place, part, n = (unused_name(df, x) for x in ("again", "place", "part", "n"))
    again = stored(df.groupBy(key).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(key), "mix-again")
    flagged = maybe_in(df, key, again, flag)
    rows = stored(flagged.where(F.col(flag)).drop(flag).withColumn(place, F.monotonically_increasing_id()), "mix-equal")
    rows = rows.withColumn(part, F.shiftright(place, 33))
    local = F.row_number().over(Window.partitionBy(part, key).orderBy(place)) - 1
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(part, key).agg(F.count(F.lit(1)).alias(n)).select(part, key, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n))
    twice = rows.withColumn(name, local).join(offsets, [part, key]).withColumn(name, F.col(name) + F.col(n))
    columns = [F.col(f"`{c}`") for c in df.columns]
    once = flagged.where(~F.col(flag)).select(*columns, F.lit(0).cast("bigint").alias(name))
    return once.unionByName(twice.select(*columns, F.col(name).cast("bigint").alias(name)))


def copies(rate, doc_id, text_hash, number, seed: str = SEED):
    """floor(rate), plus one with probability of the fraction."""
    whole = F.floor(rate)
    return (whole + (unit_hash(seed, doc_id, text_hash, number) < rate - whole).cast("long")).cast("long")


def _same(doc_id, text_hash, source):
    """A hash of what makes rows equal."""
    parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in (doc_id, text_hash, source)]
    return F.md5(F.concat_ws(":", *parts, source.isNull().cast("string")).cast("binary"))


def mix_plan(docs: DataFrame, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every row of ``docs``."""
    text_hash = F.md5(F.col("text").cast("binary"))
    sized = stored(docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"), text_hash.alias("text_hash"),
                               _same(F.col("doc_id"), text_hash, F.col("source")).alias("same")), "mix-sizes")
    targets = source_targets(sized, share, most)
    out = _with_targets(numbered(sized, "same", "number"), targets, "source", {"source_size": "source_size", "target": "target"})
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    out = out.withColumn("copies", copies(rate, F.col("doc_id"), F.col("text_hash"), F.col("number"), seed))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "copies")


def mixed(docs: DataFrame, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` repeated as often as it is taken."""
    sized = docs.select("source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
    targets = source_targets(sized, share, most)
    size, target, times, mark, same, number = (unused_name(docs, c) for c in (
        "mix_size", "mix_target", "mix_copy", "mix_text", "mix_same", "mix_number"))
    marked = docs.withColumn(mark, F.md5(F.col("text").cast("binary")))
    marked = numbered(marked.withColumn(same, _same(F.col("doc_id"), F.col(mark), F.col("source"))), same, number)
    out = _with_targets(marked, targets, "source", {"source_size": size, "target": target})
    rate = F.when(F.col(size) > 0, F.col(target) / F.col(size)).otherwise(F.lit(0.0))
    many = copies(rate, F.col("doc_id"), F.col(mark), F.col(number), seed)
    return (out.withColumn(times, F.explode(F.array_repeat(F.lit(1), many.cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


#: DuckDB SQL for :func:`mix_plan` over a relation with doc_id, text, source.
PLAN_SQL = r"""
WITH sized AS (SELECT doc_id, source, md5(text) AS text_hash,
                      row_number() OVER (PARTITION BY doc_id, md5(text), source) - 1 AS number,
                      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
               FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size,
                     [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
              FROM sized GROUP BY source),
-- with the bounds in order of bound over weight, the level rises until no further bound cuts it, then falls
stepped AS (SELECT *, 2.0 * source_size / weight AS edge,
                   sum(source_size) OVER () AS total,
                   coalesce(sum(source_size) OVER w, 0) AS fixed, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS rest
            FROM by_source
            WINDOW w AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((1.5::DOUBLE * total - 2.0::DOUBLE * fixed) / rest) AS level FROM stepped),
targets AS (SELECT source, source_size, least(level * weight, 2.0::DOUBLE * source_size) AS target FROM by_source, level),
rated AS (SELECT doc_id, size, source_size, target,
                 CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
                 ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text_hash, 'null') || ':' || number),
                                 1, 12))::BIGINT::DOUBLE
                     / 281474976710656.0::DOUBLE AS u
          FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM rated)
"""
MIX_SQL = PLAN_SQL + """
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM counted
"""
