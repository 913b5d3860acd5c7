"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles (words between ``LETTER_GAP``, A-Z
lower-cased; a text of one to four words is one shingle).  Two documents are
linked if the Jaccard similarity of their sets is at least ``THRESHOLD``;
classes are the connected components of the links.

1. Each document gets a 128-bit key of its shingle set, ``SKETCH`` MinHash
   values for comparing, and ``BANDS`` band hashes of ``ROWS`` further values.
   Documents with equal sets become one node with its number of copies.
2. Band hashes that several nodes share are buckets.  Every node is compared
   with the smallest node of its buckets; surviving pairs join nodes to
   groups.
3. Buckets that still hold more than one group are compared in full, in pairs
   of blocks of at most about ``BLOCK`` nodes, and surviving pairs join groups.
4. Within each group, again in pairs of blocks, all pairs are compared and the
   survivors verified exactly on their shingle sets.

A comparison reads the sketches ``STEP`` values at a time and drops a pair as
soon as the posterior probability that its similarity reaches the threshold
(uniform prior) is below ``TOLERANCE``.  Pairs are never rows: tasks return
one row per node and block pair with its number of links and its root.

A pair at the threshold shares no band with probability (1 - 0.8^ROWS)^BANDS,
about 1e-5, and is dropped by the posterior test with about 4e-5; pairs above
it far less.

Edge cases: null, empty and wordless texts have no shingles, hence no links
and a class each; rows with equal doc_id are documents of their own; a class is named by
its smallest doc_id (null if all are null); other columns are ignored or, in
:func:`one_per_class`, kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import (IS_LETTER, MULT, TO_LOWER, key_runs, lists, mix, only, ranges, stored, text_slices,
                                unused_name, without, words_in)
from insight.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 7, 48
SKETCH, STEP = 64, 16
TOLERANCE = 1e-5
BLOCK = 256

_rng = np.random.default_rng(20240229)
_ODD = _rng.integers(0, 2**63, ROWS * BANDS + SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of consecutive texts, and how many each has."""
    words = words_in(TO_LOWER[raw], offsets, IS_LETTER)
    many = np.maximum(words.counts - SHINGLE + 1, np.minimum(words.counts, 1))
    owner = np.repeat(np.arange(len(many)), many)
    at = ranges(words.offsets[:-1], many)
    h = np.concatenate([words.hashes, np.zeros(SHINGLE, np.uint64)])
    z = np.minimum(words.counts, SHINGLE).astype(np.uint64)[owner] * MULT
    for k in range(SHINGLE):
        inside = at + k < words.offsets[1:][owner]
        z += np.where(inside, h[at + k], np.uint64(0)) * _PLACE[k]
    z = mix(z)
    order = np.lexsort((z, owner))
    z, owner = z[order], owner[order]
    new = np.ones(len(z), bool)
    new[1:] = (z[1:] != z[:-1]) | (owner[1:] != owner[:-1])
    return z[new], np.bincount(owner[new], minlength=len(many))


def minhashes(z: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values of sets laid end to end, one row per set (empty sets: zeros)."""
    out = np.zeros((len(counts), len(_ODD)), np.uint64)
    filled = np.flatnonzero(counts)
    ends = np.cumsum(counts)
    a = 0
    while a < len(filled):  # about 32,000 values at a time stay in the cache
        first = ends[filled[a]] - counts[filled[a]]
        b = max(a + 1, int(np.searchsorted(ends[filled], first + 32_768, side="right")))
        part = z[first: ends[filled[b - 1]]]
        starts = ends[filled[a:b]] - counts[filled[a:b]] - first
        for k, m in enumerate(_ODD):
            out[filled[a:b], k] = np.minimum.reduceat(part * m, starts)
        a = b
    return out


SIGNED_TYPE = "struct<n:bigint,key_a:bigint,key_b:bigint,sketch:binary,bands:array<bigint>>"


def _signed(z: np.ndarray, counts: np.ndarray) -> pa.StructArray:
    n = len(counts)
    edges = np.concatenate([[0], np.cumsum(counts)])
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(z + np.uint64(s)), dtype=np.uint64)]) for s in (1, 2)]
    keys = [(c[edges[1:]] - c[edges[:-1]]).view(np.int64) for c in sums]
    values = minhashes(z, counts)
    sketch = (values[:, :SKETCH] >> np.uint64(32)).astype(np.uint32)
    banded = (values[:, SKETCH:].reshape(n, BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64)
    banded = mix(banded + np.arange(BANDS, dtype=np.uint64) * MULT).view(np.int64)
    some = np.where(counts > 0, BANDS, 0)
    return pa.StructArray.from_arrays(
        [pa.array(counts.astype(np.int64)), pa.array(keys[0]), pa.array(keys[1]),
         pa.array([row.tobytes() for row in sketch], pa.binary()), lists(banded[counts > 0].ravel(), some, pa.int64())],
        ["n", "key_a", "key_b", "sketch", "bands"])


def signed(text: Column) -> Column:
    """Struct: size and key of the shingle set, sketch, band hashes."""

    @F.arrow_udf(SIGNED_TYPE)
    def udf(texts: pa.Array) -> pa.Array:
        parts = [_signed(*shingles(raw, offs)) for _, _, raw, offs in text_slices(texts)]
        return pa.concat_arrays(parts) if parts else _signed(np.zeros(0, np.uint64), np.zeros(0, np.int64))

    return udf.asNondeterministic()(text)


def least_matches(n: int) -> int:
    """Fewest of n equal MinHash values that leave a pair in the run."""
    below = 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * THRESHOLD**m * (1 - THRESHOLD) ** (n + 1 - m)
        if below >= TOLERANCE:  # P(similarity >= threshold | m of n equal)
            return m
    return n


LEAST = [(n, least_matches(n)) for n in range(STEP, SKETCH + 1, STEP)]


def survivors(x: np.ndarray, y: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of x, row of y), among those allowed, that pass every step."""
    first = (x[:, None, :STEP] == y[None, :, :STEP]).sum(axis=2)
    i, j = np.nonzero(allowed & (first >= LEAST[0][1]))
    same = first[i, j]
    for n, least in LEAST[1:]:
        same = same + (x[i, n - STEP: n] == y[j, n - STEP: n]).sum(axis=1)
        keep = same >= least
        i, j, same = i[keep], j[keep], same[keep]
    return i, j


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SKETCH)


def _likely(x: Column, y: Column) -> Column:
    """Whether two sketches survive, row by row."""

    @F.arrow_udf("boolean")
    def udf(xs: pa.Array, ys: pa.Array) -> pa.Array:
        a, b = _sketches(xs), _sketches(ys)
        ok = np.ones(len(a), bool)
        for n, least in LEAST:
            live = np.flatnonzero(ok)
            ok[live] = (a[live, :n] == b[live, :n]).sum(axis=1) >= least
        return pa.array(ok)

    return udf.asNondeterministic()(x, y)


def _block_pairs(df: DataFrame, group: str, size: str) -> DataFrame:
    """Deal groups over pairs of blocks: each row goes to every pair of its block.

    ``key`` names the pair, ``side`` is 0 or 1 (a block paired with itself has
    side 0 only).  A group of at most ``BLOCK`` rows is one block.
    """
    n = F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")
    dealt = df.withColumn("block", F.pmod(F.xxhash64("id"), n).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), n - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return (dealt.withColumn("key", F.xxhash64(group, low, high))
            .withColumn("side", (F.col("block") > F.col("other")).cast("int")).drop("block", "other"))


def _pairs_of(side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows to compare: row numbers of both sides, and which pairs to look at."""
    if side.any():
        return np.flatnonzero(side == 0), np.flatnonzero(side == 1), np.ones((int((side == 0).sum()), int(side.sum())), bool)
    rows = np.arange(len(side))
    return rows, rows, np.triu(np.ones((len(side), len(side)), bool), 1)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row over the pairs."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surviving pairs between different groups of a bucket, as pairs of groups."""
    for rows in key_runs(batches, "key"):
        comp, x = rows.column("comp").to_numpy(), _sketches(rows.column("sketch"))
        left, right, allowed = _pairs_of(rows.column("side").to_numpy())
        i, j = survivors(x[left], x[right], allowed & (comp[left][:, None] != comp[right][None, :]))
        if len(i):
            a, b = comp[left[i]], comp[right[j]]
            found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])


def linked(texts: pa.Array, x: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs with similarity of at least the threshold, verified on the shingle sets."""
    left, right, allowed = _pairs_of(side)
    i, j = survivors(x[left], x[right], allowed)
    i, j = left[i], right[j]
    parts = [shingles(raw, offs) for _, _, raw, offs in text_slices(texts)]
    z, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    _, ids = np.unique(z, return_inverse=True)
    starts = np.cumsum(counts) - counts
    mark = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    keep = np.zeros(len(i), bool)
    cuts = np.concatenate([[0], np.flatnonzero(i[1:] != i[:-1]) + 1, [len(i)]]) if len(i) else np.zeros(1, int)
    for a, b in zip(cuts, cuts[1:]):
        own = ids[starts[i[a]]: starts[i[a]] + counts[i[a]]]
        mark[own] = True
        with_j = j[a:b]
        both = np.add.reduceat(mark[ids[ranges(starts[with_j], counts[with_j])]].astype(np.int64),
                               np.cumsum(counts[with_j]) - counts[with_j])
        either = len(own) + counts[with_j] - both
        keep[a:b] = both * 10 >= either * round(THRESHOLD * 10)
        mark[own] = False
    return i[keep], j[keep]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node of a block pair: its links there (copies counted) and its root."""
    for rows in key_runs(batches, "key"):
        node, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
        i, j = linked(rows.column("text").combine_chunks(), _sketches(rows.column("sketch")),
                      rows.column("side").to_numpy())
        if len(i):
            links = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
            root = node[_roots(len(node), i, j)]
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[some]), pa.array(root[some]), pa.array(links[some].astype(np.int64))], ["id", "root", "links"])


def _sorted_tasks(df: DataFrame) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key")


def classify(docs: DataFrame) -> tuple[DataFrame, str, DataFrame]:
    """(stored rows with a row id, name of the row id, classes).

    Classes has one row per document: id, doc_id, comp (its class by row id),
    n_links.
    """
    uid, s = unused_name(docs, "row_id"), unused_name(docs, "signed")
    rows = stored(docs.withColumn(uid, F.monotonically_increasing_id()).withColumn(s, signed(F.col("text"))), "jaccard-rows")
    marks = rows.select(F.col(uid).alias("id"), "doc_id", f"{s}.n", f"{s}.key_a", f"{s}.key_b")
    alone = F.when(F.col("n") == 0, F.col("id"))  # documents without shingles are equal to none
    marks = marks.withColumn("alone", F.coalesce(alone, F.lit(-1)))
    key = ["key_a", "key_b", "n", "alone"]
    sets = marks.groupBy(*key).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    copied = stored(sets.where("copies > 1"), "jaccard-copied")
    of = (marks.join(copied, key, "left").select(
        "id", "doc_id", "n", F.coalesce("node", "id").alias("node"), F.coalesce("copies", F.lit(1)).alias("copies")))
    members = stored(of, "jaccard-members")
    spare = members.where("id <> node").select(F.col("id").alias(uid))

    posted = (without(rows.select(uid, F.col(f"{s}.bands").alias("bands")), uid, spare)
              .select(F.col(uid).alias("id"), F.explode("bands").alias("bucket")))
    posted = stored(posted, "jaccard-posted")
    buckets = stored(posted.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("leader"))
                     .where("size > 1"), "jaccard-buckets")
    shared = stored(only(posted, "bucket", buckets.select("bucket")).join(buckets, "bucket"), "jaccard-shared")
    # from here on, only nodes that share a bucket with another
    near = stored(only(rows.select(uid, "text", F.col(f"{s}.sketch").alias("sketch")), uid,
                       shared.select(F.col("id").alias(uid)).distinct()).withColumnRenamed(uid, "id"), "jaccard-near")
    sketches = near.select("id", "sketch")

    # every node against the leader of each of its buckets
    led = shared.where("id <> leader").select("id", "leader").distinct()
    star = (led.join(sketches, "id").join(sketches.select(F.col("id").alias("leader"), F.col("sketch").alias("other")), "leader")
            .where(_likely(F.col("sketch"), F.col("other"))).select(F.col("id").alias("a"), F.col("leader").alias("b")))
    first = components(star)

    # buckets with more than one group: all pairs of different groups
    grouped = stored(shared.select("bucket", "size", "id").join(first, "id", "left")
                     .withColumn("comp", F.coalesce("comp", "id")), "jaccard-grouped")
    open_buckets = (grouped.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
                    .where("low <> high").select("bucket"))
    todo = grouped.join(open_buckets, "bucket").join(sketches, "id")
    bridges = _sorted_tasks(_block_pairs(todo, "bucket", "size").select("key", "side", "comp", "sketch")).mapInArrow(
        _join_groups, "a long, b long").distinct()
    second = components(bridges)
    merged = grouped.select("id", "comp").distinct().join(
        second.select(F.col("id").alias("comp"), F.col("comp").alias("top")), "comp", "left").select(
        "id", F.coalesce("top", "comp").alias("comp"))
    merged = stored(merged, "jaccard-groups")
    sizes = stored(merged.groupBy("comp").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "jaccard-sizes")

    # exact verification inside each group
    work = merged.join(sizes, "comp").join(members.where("id = node").select("id", "copies"), "id").join(near, "id")
    verified = stored(_sorted_tasks(_block_pairs(work, "comp", "size").select("key", "side", "id", "copies", "text", "sketch"))
                      .mapInArrow(_verify, "id long, root long, links long"), "jaccard-links")
    final = components(verified.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("id").agg(F.sum("links").alias("links"))
    # a node may stand for very many copies: two stored tables are joined, so that Spark can split it
    known = stored(links.join(final, "id", "left").select(F.col("id").alias("node"), "links", F.coalesce("comp", "id").alias("comp")),
                   "jaccard-known")
    classes = members.join(known, "node", "left").select(
        "id", "doc_id", F.coalesce("comp", "node").alias("comp"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows, uid, stored(classes, "jaccard-classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), n_links for every document."""
    _, _, classes = classify(docs.select("doc_id", "text"))
    names = stored(classes.groupBy("comp").agg(F.min("doc_id").alias("class_id")), "jaccard-names")
    return classes.join(names, "comp").select("doc_id", "class_id", "n_links")


def one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one of the smallest doc_id."""
    rows, uid, classes = classify(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "id")
    best = stored(classes.groupBy("comp").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("size"))
                  .where("size > 1").select("comp", F.col("best.id").alias("best")), "jaccard-best")
    spare = stored(classes.join(best, "comp").where("id <> best").select(F.col("id").alias(uid)), "jaccard-spare")
    return without(rows, uid, spare).select(*[F.col(f"`{c}`") for c in docs.columns])
