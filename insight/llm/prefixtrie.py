"""Prefix trie of conversations by whole-sequence collapse.

Conversations are rebuilt first: conversation c opens with the first h turns of
conversation ``c - c % BLOCK``, where h is its id's crc32 modulo ``LEND``, and goes
on with its own turns after its first h.  Identical rebuilt conversations are
grouped into one weighted sequence with the list of its ends; sequences that are
proper prefixes of others drop out by an anti-join, which leaves the leaves; the
prefixes of the weighted sequences are aggregated into the nodes.

A prefix is known by two 64-bit hashes: the exclusive or of its turns' hashes, each
salted with its depth.  So a prefix's hash is a running aggregate, and a whole
sequence's hash is a plain one that needs no order and combines before the shuffle.

Sums over subtrees come without walking the trie.  The number of members times the
words of a node, summed over a subtree, is the sum over the members of their words
from the subtree's top on.  The words of each distinct node once: a node belongs to
the sequence of its smallest member, and those nodes of a sequence are its last ones,
so that they add the words after the later of the top and the sequence's first own
node.

No conversation meets in one task: turns are numbered by sorted ranges and running
values are taken in chunks of ``CHUNK`` turns.  The end list of a node is hashed as a
stream of pieces of at most 2^16 ids, in order (SHA-256 can't be cut, so the pieces of
one list pass one task, one after the other).

Edge cases: rows with null conv_id belong to no conversation; null turns come first,
equal turns stand in the order of role and text; null role and text are empty; repeated
rows are turns of their own; a rebuilt conversation without turns ends at the root;
other columns are ignored; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.common import stored, words_of
from insight.operators.ranking import ranged

#: Who lends turns to whom, and how many at most (less one).
BLOCK, LEND = 20, 4
#: Turns whose running values are taken together.
CHUNK = 4096

KEY = ["depth", "a", "b"]


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth from 1, role, text) of the rebuilt conversations, and all conv_ids."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("tie"))
    rows = ranged(turns, ["conv_id", "turn", "role", "text", "tie"])
    runs = stored(rows.groupBy("__part", "conv_id").agg(F.min("__at").alias("lo"), F.count(F.lit(1)).alias("n")), "trie-runs")
    sizes = runs.groupBy("conv_id").agg(F.sum("n").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LEND
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    lenders = sizes.where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("has"))
    earlier = Window.partitionBy("conv_id").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    placed = (runs.withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("lo"))
              .withColumn("base", base).join(lenders, "base", "left")
              .select("__part", "conv_id", "shift", (h - F.least(h, F.coalesce("has", F.lit(0)))).alias("short")))
    own = (rows.join(placed, ["__part", "conv_id"])
           .withColumn("place", F.col("__at") + F.col("shift")))
    heads = own.where((F.col("conv_id") % BLOCK == 0) & (F.col("place") < LEND - 1)).select(
        F.col("conv_id").alias("base"), "place", "role", "text")
    lent = (sizes.select("conv_id", base.alias("base"), h.alias("h")).join(heads, "base")
            .where(F.col("place") < F.col("h"))
            .select("conv_id", (F.col("place") + 1).alias("depth"), "role", "text"))
    kept = own.where(F.col("place") >= h).select(
        "conv_id", (F.col("place") - F.col("short") + 1).alias("depth"), "role", "text")
    return kept.unionByName(lent), sizes.select("conv_id")


def _hashed(turns: DataFrame) -> DataFrame:
    salted = [F.xxhash64(F.lit(i), "depth", "role", "text").alias(n) for i, n in ((1, "a"), (2, "b"))]
    return turns.select("conv_id", "depth", *salted, F.size(words_of(F.col("text"))).cast("long").alias("words"))


def _running(turns: DataFrame) -> DataFrame:
    """Turns with the hashes (``a``, ``b``) of the prefix that they end, those of its parent, and the words before them."""
    turns = turns.withColumn("chunk", F.floor((F.col("depth") - 1) / CHUNK))
    whole = turns.groupBy("conv_id", "chunk").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("words").alias("words"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select("conv_id", "chunk", F.bit_xor("a").over(earlier).alias("a0"), F.bit_xor("b").over(earlier).alias("b0"),
                           F.sum("words").over(earlier).alias("w0")).where("chunk > 0")
    here = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = turns.select("*", F.bit_xor("a").over(here).alias("xa"), F.bit_xor("b").over(here).alias("xb"),
                         F.sum("words").over(here).alias("xw"))
    zero = F.lit(0).cast("long")
    pa_ = F.col("xa").bitwiseXOR(F.coalesce("a0", zero))
    pb = F.col("xb").bitwiseXOR(F.coalesce("b0", zero))
    return local.join(offsets, ["conv_id", "chunk"], "left").select(
        "conv_id", "depth", pa_.alias("a"), pb.alias("b"),
        pa_.bitwiseXOR(F.col("a")).alias("up_a"), pb.bitwiseXOR(F.col("b")).alias("up_b"),
        (F.col("xw") + F.coalesce("w0", zero) - F.col("words")).alias("before"))


def _list_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of each sequence's conv_ids, ascending and comma-joined."""
    pieces = (ends.groupBy(*KEY, F.shiftright("conv_id", 16).alias("piece"))
              .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done = []
            for d, a, b, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if (d, a, b) == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (d, a, b), hashlib.sha256()
                sha.update(ids.encode())
            yield out(done)
        if key is not None:
            yield out([(*key, sha.hexdigest())])

    def out(rows):
        return pa.RecordBatch.from_pylist([dict(zip((*KEY, "ends_sha256"), r)) for r in rows], pa.schema(
            [(c, pa.int64()) for c in KEY] + [("ends_sha256", pa.string())]))

    return ordered.mapInArrow(digests, "depth bigint, a bigint, b bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of the conversations ``turns`` (conv_id, depth, role, text); ``convs`` has all conv_ids."""
    hashed = stored(_hashed(turns), "trie-turns")
    whole = hashed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
                                          F.sum("words").alias("total"))
    zero = F.lit(0).cast("long")
    ends = stored(convs.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in (*KEY, "total")]), "trie-ends")
    sequences = stored(ends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("member"),
                                              F.max("total").alias("total")), "trie-sequences")

    chosen = hashed.join(sequences.select(F.col("member").alias("conv_id")), "conv_id", "left_semi")
    roots = sequences.select(F.col("member").alias("conv_id"), *[zero.alias(c) for c in (*KEY, "up_a", "up_b", "before")])
    paths = stored(_running(chosen).unionByName(roots).withColumnRenamed("conv_id", "member"), "trie-paths")

    smallest = paths.groupBy(*KEY).agg(F.min("member").alias("conv_id"))
    fresh = (paths.join(smallest, KEY).where("conv_id = member")
             .groupBy("member").agg(F.min("before").alias("fresh")))
    inner = paths.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
    leaves = sequences.join(inner.distinct(), KEY, "left_anti").select("member", F.lit(1).cast("long").alias("leaf"))
    known = (sequences.select("member", "weight", "total").join(fresh, "member", "left").join(leaves, "member", "left")
             .withColumn("leaf", F.coalesce("leaf", zero)).withColumn("fresh", F.coalesce("fresh", "total")))
    nodes = stored(paths.join(known, "member").groupBy(*KEY).agg(
        F.min("member").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        (F.sum(F.col("weight") * (F.col("total") - F.col("before")))
         - F.sum(F.col("total") - F.greatest("before", "fresh"))).alias("saved_tokens"),
        F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b")), "trie-nodes")

    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
                         F.col("conv_id").alias("parent_conv_id"))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return (nodes.join(children, KEY, "left").join(_list_hashes(ends), KEY, "left")
            .join(above, ["depth", "up_a", "up_b"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256")))


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of each node's last turn (null for the root)."""
    return nodes.join(turns.select("conv_id", "depth", "role", "text"), ["conv_id", "depth"], "left")


#: DuckDB SQL for :func:`prefix_trie` over the rebuilt conversations.
TRIE_SQL = r"""
WITH t AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)),
        lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
            lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 4 AS h
    FROM ids),
built AS (
    SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.base AND t.place < c.h
    UNION ALL SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.h),
whole AS (
    SELECT c.conv_id, coalesce(turns, []) AS turns FROM c
    LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM built GROUP BY conv_id) USING (conv_id)),
paths AS (SELECT conv_id, turns[1:d] AS p, d, len(turns) = d AS ends FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM whole)),
nodes AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids,
           CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[-1].text, '[^\x20\x09-\x0D]+')) END AS words
    FROM paths GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (p, d)),
above AS (
    SELECT p[1:e] AS p, e AS d, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children = 0) AS leaves
    FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM full_nodes) GROUP BY ALL)
SELECT x.conv_id::BIGINT AS conv_id, x.d::BIGINT AS depth, parent.conv_id::BIGINT AS parent_conv_id, x.n_convs::BIGINT AS n_convs,
       x.n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(x.ids) AS ends_sha256
FROM full_nodes x JOIN above USING (p, d) LEFT JOIN nodes parent ON x.d > 0 AND parent.d = x.d - 1 AND parent.p = x.p[1:x.d - 1]
"""
