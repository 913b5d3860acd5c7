"""Source divergence audit by count-level bitmaps.

A group is a (lang, source).  Terms are runs of letters, A-Z lower-cased; a language
keeps the terms that occur in at least ``MIN_DOCS`` of its documents.  Kept terms are
numbered inside blocks of ``BITS``.  For each group and block, every occurring count is
one bitset of term numbers, and what is in none of them is the bitset of count 0.  Two
groups' bitsets, ANDed and popcounted, give the number of terms in each joint cell
(count here, count there); times the distance of the two counts' values, summed over
the cells and blocks, this is the divergence of the pair.

A count's value is ``1 + floor(SCALE * (count + 5) / (N + 5 * V))``, in whole numbers: V
is the number of kept terms, N the group's (or the language's) sum of their counts.

Texts are cut into words in tasks, which send each slice's distinct (group, term) with
counts; all that follows are grouped sums, so a hot source is combined before it moves.
The pair work is dealt by language, block and pair of source tiles (``TILE`` sources a
side), so a task holds at most ``2 * TILE * (BITS + 1)`` levels.

Edge cases: null text, lang and source are empty strings; texts without terms count
for nothing, but their groups are listed; a language without kept terms gives pairs of
value 0; a source alone in its language has no pairs; repeated documents count each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.common import TO_LOWER, stored, text_slices, words_in

MIN_DOCS = 30
TOP_TERMS = 50
SCALE, ADD = 1_000_000_000, 5
#: Terms of a block; sources of a tile.
BITS, TILE = 256, 64
#: Text whose terms are counted together in a task.
COUNT_BYTES = 8 << 20
WORDS = [f"w{i}" for i in range(BITS // 64)]

_byte = np.arange(256)
#: Letters, after lower-casing: no byte of 0x00-0x60 or 0x7B-0x7F.
IS_TERM = ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def slice_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of rows: each group's distinct terms, with occurrences and documents."""
    for batch in batches:
        langs, sources = (np.array(batch.column(c).to_pylist(), dtype=object) for c in ("lang", "source"))
        (_, lang), (found, source) = (np.unique(x, return_inverse=True) for x in (langs, sources))
        _, first, group = np.unique(lang * len(found) + source, return_index=True, return_inverse=True)
        for a, b, raw, offs in text_slices(batch.column("text"), COUNT_BYTES):
            low = TO_LOWER[raw]
            words = words_in(low, offs, IS_TERM)
            if not len(words.hashes):
                continue
            vocabulary, at, term = np.unique(words.hashes, return_index=True, return_inverse=True)
            in_docs, times = np.unique(words.text_ids * len(vocabulary) + term, return_counts=True)
            doc, term = in_docs // len(vocabulary), in_docs % len(vocabulary)
            cells, inverse = np.unique(group[a:b][doc] * len(vocabulary) + term, return_inverse=True)
            n = np.bincount(inverse, times).astype(np.int64)
            of, term = first[cells // len(vocabulary)], cells % len(vocabulary)
            text = low.tobytes()
            names = np.array([text[s:e].decode() for s, e in zip(words.starts[at], words.ends[at])], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs[of], pa.string()), pa.array(sources[of], pa.string()), pa.array(names[term], pa.string()),
                 pa.array(n), pa.array(np.bincount(inverse).astype(np.int64))], schema=COUNTS)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group."""
    full = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    sliced = full.mapInArrow(slice_counts, "lang string, source string, term string, n bigint, docs bigint")
    return sliced.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _value(count: str, total: str, terms: str) -> Column:
    """The count's value; decimals, as the product passes 64 bits on large corpora."""
    whole = "CAST({} AS DECIMAL(38, 0))"
    above = f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {ADD} AS DECIMAL(20, 0))"
    return F.expr(f"1 + CAST({whole.format(above)} div CAST({total} + {ADD} * {terms} AS DECIMAL(20, 0)) AS BIGINT)")


class Audit:
    """Stored tables of one audit: kept terms with their place, and the groups' counts of them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        counts = stored(term_counts(docs), "audit-counts")
        total = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        kept = stored(total.select("lang", "term", "all_n"), "audit-kept")
        buckets = max(1, kept.count() // BITS)
        place = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("term")) - 1
        placed = (kept.withColumn("bucket", F.pmod(F.xxhash64("lang", "term"), F.lit(buckets))).withColumn("place", place)
                  .select("lang", "term", "all_n", F.struct("bucket", F.floor(F.col("place") / BITS).alias("part")).alias("block"),
                          (F.col("place") % BITS).alias("bit")))
        self.kept = stored(placed, "audit-placed")
        self.counts = stored(counts.drop("docs").join(self.kept, ["lang", "term"]), "audit-kept-counts")
        names = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
        sums = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        langs = self.kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("all_total"))
        zero = F.lit(0).cast("long")
        self.groups = stored(names.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
                             .fillna(0, ["total", "terms", "all_total"]).withColumn("zero", zero), "audit-groups")

    def levels(self) -> DataFrame:
        """(lang, source, block, value, w0, w1, ...): the bitset of each occurring count of a group in a block.

        Count 0 has its row in every block, with no bits: they are the complement.
        Languages without kept terms have one block.
        """
        bits = [F.bit_or(F.when(F.floor(F.col("bit") / 64) == i, F.expr("shiftleft(1L, cast(bit % 64 as int))")).otherwise(F.lit(0).cast("long"))).alias(w)
                for i, w in enumerate(WORDS)]
        found = self.counts.groupBy("lang", "source", "block", "n").agg(*bits)
        found = (found.join(self.groups.select("lang", "source", "total", "terms"), ["lang", "source"])
                 .select("lang", "source", "block", F.lit(False).alias("rest"), _value("n", "total", "terms").alias("value"), *WORDS))
        blocks = self.kept.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"))
        one = F.struct(F.lit(-1).cast("long").alias("bucket"), F.lit(0).cast("long").alias("part"))
        rest = (self.groups.join(blocks, "lang", "left")
                .select("lang", "source", F.coalesce("block", one).alias("block"), F.lit(True).alias("rest"),
                        F.when(F.col("terms") > 0, _value("zero", "total", "greatest(terms, 1)")).otherwise(F.lit(0).cast("long")).alias("value"),
                        F.coalesce("size", F.lit(0).cast("long")).alias("w0"), *[F.lit(0).cast("long").alias(w) for w in WORDS[1:]]))
        return found.unionByName(rest)

    def pair_sums(self) -> DataFrame:
        """(lang, source, item, value) for every two sources of a language, both ways."""
        most = self.groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        tiles = max(1, -(-most // TILE))
        own = F.pmod(F.xxhash64("source"), F.lit(tiles))
        dealt = (self.levels().withColumn("tile", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)).cast("array<bigint>")))
                 .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")))

        def cells(table: pa.Table) -> pa.Table:
            return pair_cells(table)

        found = dealt.groupBy("lang", "block", "low", "high").applyInArrow(cells, "lang string, source string, item string, value bigint")
        return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def pairs(self) -> DataFrame:
        """All other sources of each group's language, ranked."""
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return self.pair_sums().select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """The terms that each group uses more than its language, ranked."""
        both = (self.counts.join(self.groups, ["lang", "source"])
                .withColumn("value", _value("n", "total", "terms") - _value("all_n", "all_total", "terms")).where("value > 0"))
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return (both.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
                .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


def pair_cells(table: pa.Table) -> pa.Table:
    """Joint cells of all pairs of sources of one (lang, block, tile pair), as sums by pair."""
    names, of = np.unique(np.array(table.column("source").to_pylist(), dtype=object), return_inverse=True)
    order = np.argsort(of, kind="stable")
    of = of[order]
    value = table.column("value").to_numpy()[order]
    rest = table.column("rest").to_numpy(zero_copy_only=False)[order]
    tile = table.column("tile").to_numpy()[order]
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    bits = np.stack([table.column(w).to_numpy()[order] for w in WORDS], axis=1).view(np.uint64)
    size = int(bits[rest, 0].max())  # a rest row comes with the number of the block's terms
    all_bits = np.array([(1 << min(64, max(0, size - 64 * i))) - 1 for i in range(len(WORDS))], np.uint64)
    bits[rest] = 0
    starts = np.searchsorted(of, np.arange(len(names)))
    some = np.bitwise_or.reduceat(bits, starts, axis=0)
    bits[rest] = all_bits & ~some[of[rest]]
    ends = np.append(starts[1:], len(of))
    tile_of = tile[starts]
    left, right, sums = [], [], []
    for i in np.flatnonzero(tile_of == low):
        mine = slice(starts[i], ends[i])
        total = np.zeros(len(of), np.int64)
        for j in range(starts[i], ends[i], 32):  # some levels at a time: small temporaries
            part = slice(j, min(j + 32, mine.stop))
            cells = np.bitwise_count(bits[part, None, :] & bits[None, :, :]).sum(axis=2, dtype=np.int64)
            total += (cells * np.abs(value[part, None] - value[None, :])).sum(axis=0)
        by = np.add.reduceat(total, starts)
        others = np.flatnonzero((tile_of == high) & (np.arange(len(names)) != i))
        left.append(np.full(len(others), i))
        right.append(others)
        sums.append(by[others])
    empty = np.zeros(0, np.int64)
    left, right, sums = (np.concatenate([empty, *x]).astype(np.int64) for x in (left, right, sums))
    if low != high:
        left, right, sums = np.concatenate([left, right]), np.concatenate([right, left]), np.concatenate([sums, sums])
    lang = table.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(left), pa.string()), "source": pa.array(names[left], pa.string()),
                     "item": pa.array(names[right], pa.string()), "value": pa.array(sums)})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources and each group's strongest terms."""
    tables = Audit(docs, min_docs)
    return tables.pairs().unionByName(tables.terms(top))


#: DuckDB SQL for :func:`audit`.
AUDIT_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS all_n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(all_n) AS all_total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (coalesce(total, 0) + 5 * v) AS p,
           1 + (1000000000::HUGEINT * (all_n + 5)) // (all_total + 5 * v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN totals USING (lang, source)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM grid WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
