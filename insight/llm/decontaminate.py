"""Benchmark decontamination by an FM-index per shard of documents.

A window is ``WINDOW`` consecutive item words; an item of fewer words, but not none, is
one window.  Words stand between ``LETTER_GAP``, with A-Z lower-cased; they are compared
by 64-bit hash.

1. The benchmark's distinct windows are a table, with their runs of ``KEY`` words (a
   shorter window is one run).
2. One scan of the documents finds which of these runs each text has.  Tasks are sent a
   bit filter of the runs, of one size whatever the benchmark's.  A window's key is its
   run that fewest texts have; a join by key gives each text the windows that it can hold.
3. Texts with such windows are dealt to shards of about ``SHARD_BYTES``, equal texts once,
   and each shard gets the windows of its texts.  The shard's words become symbols; its
   FM-index holds the Burrows-Wheeler transform of the symbol sequence in a wavelet
   matrix, plus suffix positions sampled every ``SAMPLE`` words.  All windows are searched
   backwards at once; matching rows are walked to a sampled suffix to locate them; located
   windows become spans, which are merged per text.

So the cost of a document does not depend on the benchmark's size, but on what it shares
with it, and nothing of the benchmark is gathered on the driver.

Edge cases: null, empty and wordless documents have no words and no hits; null
or wordless items have no windows; items with equal ids count once; repeated
documents are searched once; other columns are ignored or, in
:func:`decontaminated`, kept; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import (IS_LETTER, MULT, TO_LOWER, bloom_bits, in_bloom, key_runs, lists, maybe_in, mix, ranges, stored,
                                text_slices, unused_name, words_in)

WINDOW = 10
SAMPLE = 8
#: Words of a window's key.
KEY = 3
#: Text of a shard, about.
SHARD_BYTES = 1 << 20
#: The two symbols below the words: the end of the shard, the end of a text.
END, BREAK, FIRST = 0, 1, 2


class RankBits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before position i."""
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) > 0


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a sequence with a unique smallest last symbol.

    The first sort takes as many symbols as fit in 63 bits; then the sorted
    length doubles, and only suffixes that still tie are sorted again.
    """
    n = len(s)
    bits = max(1, int(s.max()).bit_length())
    depth = max(1, min(8, 63 // bits))
    key = np.zeros(n, np.int64)
    for j in range(depth):
        key <<= bits
        key[: n - j] |= s[j:]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    start = np.flatnonzero(new)
    rank[order] = start[np.cumsum(new) - 1]
    tied = ~(new & np.concatenate([new[1:], [True]]))
    slots = np.flatnonzero(tied)  # positions in `order` that are not settled
    while len(slots):
        rows = order[slots]
        ahead = rows + depth
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[rows]
        again = np.lexsort((second, group))
        rows, group, second = rows[again], group[again], second[again]
        order[slots] = rows
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        rank[rows] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        depth *= 2
    return order


class FmIndex:
    """FM-index of symbols that end in the only ``END``."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_order(symbols)
        self.n = len(symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        sampled = order % SAMPLE == 0
        self.marks, self.samples = RankBits(sampled), order[sampled]
        self.levels = []
        bits = max(1, int(n_symbols - 1).bit_length())
        rest = symbols[order - 1]  # the transform: the symbol before each suffix
        for k in range(bits - 1, -1, -1):
            one = (rest >> k) & 1 > 0
            self.levels.append((k, RankBits(one), int(len(one) - one.sum())))
            rest = np.concatenate([rest[~one], rest[one]])
        symbol = np.arange(n_symbols)
        self.first = self._down(symbol, np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits, zeros in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> k) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before position i of the transform."""
        return self._down(symbol, i) - self.first[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of patterns (rows, right-aligned; symbol -1 occurs nowhere)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        for j in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > patterns.shape[1] - 1 - j) & (high > low))
            symbol = patterns[live, j]
            known = symbol >= 0
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.less[symbol] + self.rank(symbol, low[live])
            high[live] = self.less[symbol] + self.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a sampled suffix."""
        out, steps = np.empty(len(rows), np.int64), 0
        where, rows = np.arange(len(rows)), rows.copy()
        while len(rows):
            done = self.marks.get(rows)
            out[where[done]] = self.samples[self.marks.ones(rows[done])] + steps
            where, rows = where[~done], rows[~done]
            symbol, i = np.zeros(len(rows), np.int64), rows
            for _, bits, zeros in self.levels:
                one, ones = bits.get(i), bits.ones(i)
                symbol = symbol * 2 + one
                i = np.where(one, zeros + ones, i - ones)
            rows = self.less[symbol] + i - self.first[symbol]
            steps += 1
        return out


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes."""
    out = np.full(max(0, len(hashes) - n + 1), n, np.uint64) * MULT
    for j in range(n):
        out = (out ^ hashes[j: j + len(out)]) * np.uint64(0x100000001B3)
    return mix(out)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, item, words, keys): the windows of each item, with the runs that can be their key."""
    kind = pa.schema([("window", pa.int64()), ("item", pa.string()), ("words", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))])
    for batch in batches:
        ids = batch.column("item").to_pylist()
        for a, _, raw, offs in text_slices(batch.column("text")):
            words = words_in(TO_LOWER[raw], offs, IS_LETTER)
            for size in range(1, WINDOW + 1):
                fits = words.counts >= WINDOW if size == WINDOW else words.counts == size
                text = np.flatnonzero(fits)
                many = words.counts[text] - size + 1
                first = ranges(words.offsets[text], many)
                if not len(first):
                    continue
                key = min(size, KEY)
                held = np.full(len(first), size - key + 1)
                flat = words.hashes[ranges(first, np.full(len(first), size))].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs(words.hashes, size)[first].view(np.int64)), pa.array([ids[a + t] for t in np.repeat(text, many)], pa.string()),
                     lists(flat, np.full(len(first), size), pa.int64()),
                     lists(runs(words.hashes, key)[ranges(first, held)].view(np.int64), held, pa.int64())], schema=kind)


class Benchmark:
    """Stored tables: distinct windows (window, words), the runs that can be their keys (window, key), the items that hold them."""

    def __init__(self, items: DataFrame):
        named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text").where(F.col("text").isNotNull())
        found = stored(named.mapInArrow(_windows, "window bigint, item string, words array<bigint>, keys array<bigint>"), "bench-windows")
        self.items = stored(found.select("window", "item").distinct(), "bench-items")
        self.windows = stored(found.dropDuplicates(["window"]).drop("item"), "bench-distinct")
        self.keys = stored(self.windows.select("window", F.explode(F.array_distinct("keys")).alias("key")), "bench-keys")
        self.sizes = [r[0] for r in self.windows.select(F.least(F.size("words"), F.lit(KEY)).alias("size")).distinct().collect()]

    def rarest(self, often: DataFrame) -> DataFrame:
        """(window, key): the key of each window that fewest texts have, by (key, n); windows with a key that no text has are left out."""
        known = self.keys.join(often, "key", "left").groupBy("window").agg(
            F.count_if(F.col("n").isNull()).alias("missing"), F.min_by("key", F.struct("n", "key")).alias("key"))
        return known.where("missing = 0").select("window", "key")


def shard_hits(words, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is each word hit, text of each pair, window of each pair) for one shard and windows (rows of hashes, right-aligned)."""
    hit = np.zeros(len(words.hashes), bool)
    none = np.zeros(0, np.int64)
    if not len(words.hashes) or not len(lengths):
        return hit, none, none
    vocabulary, symbol = np.unique(words.hashes, return_inverse=True)
    filled = np.flatnonzero(words.counts)
    counts = words.counts[filled]
    begin = np.cumsum(counts + 1) - (counts + 1)  # each text is followed by a break
    symbols = np.full(int(counts.sum()) + len(counts) + 1, BREAK, np.int64)
    symbols[ranges(begin, counts)] = symbol + FIRST
    symbols[-1] = END
    at = np.minimum(np.searchsorted(vocabulary, patterns), len(vocabulary) - 1)
    patterns = np.where(vocabulary[at] == patterns, at + FIRST, -1)
    index = FmIndex(symbols, len(vocabulary) + FIRST)
    low, high = index.search(patterns, lengths)
    found = np.flatnonzero(high > low)
    many = high[found] - low[found]
    window = np.repeat(found, many)
    place = index.locate(ranges(low[found], many))
    owner = np.searchsorted(begin, place, side="right") - 1
    text = filled[owner]
    first = words.offsets[text] + place - begin[owner]
    change = np.zeros(len(hit) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + lengths[window], -1)
    hit[:] = np.cumsum(change[:-1]) > 0
    pairs = np.unique(np.stack([text, window]), axis=1)
    return hit, pairs[0], pairs[1]


SCAN_TYPE = "struct<n_words:bigint,n_bytes:bigint,keys:array<bigint>>"
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])


def scan_texts(text: Column, sent, sizes: list[int]) -> Column:
    """Struct per text: words, bytes, distinct runs of the given sizes that pass the filter."""

    @F.arrow_udf(SCAN_TYPE)
    def udf(texts: pa.Array) -> pa.Array:
        bits, parts = sent.value, []
        for _, _, raw, offs in text_slices(texts):
            words = words_in(TO_LOWER[raw], offs, IS_LETTER)
            owner, pairs = words.text_ids, [np.zeros((2, 0), np.int64)]
            for size in sizes:
                key = runs(words.hashes, size)
                some = in_bloom(bits, key)
                some = some[owner[some] == owner[some + size - 1]]
                pairs.append(np.stack([owner[some], key[some].view(np.int64)]))
            pairs = np.unique(np.concatenate(pairs, axis=1), axis=1)
            n = len(words.counts)
            parts.append(pa.StructArray.from_arrays(
                [pa.array(words.counts.astype(np.int64)), pa.array(np.diff(offs).astype(np.int64)),
                 lists(pairs[1], np.bincount(pairs[0], minlength=n), pa.int64())], ["n_words", "n_bytes", "keys"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
            [("n_words", pa.int64()), ("n_bytes", pa.int64()), ("keys", pa.list_(pa.int64()))]))

    return udf.asNondeterministic()(text)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key_a, key_b, spans, windows) of the texts of each shard that have hits; rows come sorted by shard."""
    kind = pa.schema([("key_a", pa.int64()), ("key_b", pa.int64()), ("spans", pa.list_(_SPAN)), ("windows", pa.list_(pa.int64()))])
    for table in key_runs(batches, "shard"):
        asked = table.filter(table.column("text").is_null()).combine_chunks()
        texts = table.filter(table.column("text").is_valid()).combine_chunks()
        window, at = np.unique(asked.column("window").to_numpy(), return_index=True)
        words = asked.column("words").combine_chunks()
        start, size = words.offsets.to_numpy()[:-1][at].astype(np.int64), words.value_lengths().to_numpy()[at].astype(np.int64)
        patterns = np.zeros((len(window), WINDOW), np.uint64)
        row = np.repeat(np.arange(len(window)), size)
        patterns[row, WINDOW - size[row] + ranges(np.zeros(len(size), np.int64), size)] = words.values.to_numpy().view(np.uint64)[ranges(start, size)]
        for a, b, raw, offs in text_slices(texts.column("text")):
            found = words_in(TO_LOWER[raw], offs, IS_LETTER)
            hit, owner, which = shard_hits(found, patterns, size)
            bounds = np.zeros(len(hit) + 1, bool)
            bounds[found.offsets] = True
            first = np.flatnonzero(hit & (~np.concatenate([[False], hit[:-1]]) | bounds[:-1]))
            last = np.flatnonzero(hit & (~np.concatenate([hit[1:], [False]]) | bounds[1:]))
            of = np.searchsorted(found.offsets, first, side="right") - 1
            spans = pa.StructArray.from_arrays([pa.array(first - found.offsets[of]), pa.array(last - found.offsets[of])], fields=list(_SPAN))
            some = np.unique(of)
            keys = [texts.column(k).to_numpy()[a:b][some] for k in ("key_a", "key_b")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0]), pa.array(keys[1]), lists(spans, np.bincount(of, minlength=b - a)[some], _SPAN),
                 lists(window[which], np.bincount(owner, minlength=b - a)[some], pa.int64())], schema=kind)


def _keys(text: Column) -> list[Column]:
    """Two hashes by which equal texts are known."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


KEYS = ["key_a", "key_b"]


def text_hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scan, (row columns but text, key_a, key_b, n_words), and the hits, (key_a, key_b, spans, items), of ``docs`` with key_a and key_b."""
    bench = Benchmark(items)
    sent = docs.sparkSession.sparkContext.broadcast(bloom_bits(bench.keys.select("key").distinct()))
    scan = docs.withColumn("scan", scan_texts(F.col("text"), sent, bench.sizes)).drop("text")
    scan = stored(scan.select(*[c for c in scan.columns if c != "scan"], "scan.*"), "hits-scan")
    sent.unpersist()
    held = stored(scan.where(F.size("keys") > 0).select(*KEYS, "n_bytes", F.explode("keys").alias("key")).distinct(), "hits-held")
    rarest = stored(bench.rarest(held.groupBy("key").agg(F.count(F.lit(1)).alias("n"))), "hits-rarest")
    asked = stored(held.join(rarest, "key").drop("key").join(bench.windows.drop("keys"), "window"), "hits-asked")
    wanted = stored(asked.select(*KEYS, "n_bytes").distinct(), "hits-wanted")
    total = wanted.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    some = maybe_in(docs.select(*KEYS, "text"), "key_a", wanted.select("key_a"), "some").where("some AND text IS NOT NULL")
    texts = some.groupBy(*KEYS).agg(F.first("text").alias("text")).join(wanted.select(*KEYS), KEYS, "left_semi")
    rows = texts.select(*KEYS, "text", F.lit(None).cast("bigint").alias("window"), F.lit(None).cast("array<bigint>").alias("words")).unionByName(
        asked.select(*KEYS, F.lit(None).cast("string").alias("text"), "window", "words"))
    dealt = rows.withColumn("shard", F.pmod("key_a", F.lit(shards))).repartition(min(shards, 20_000), "shard").sortWithinPartitions("shard")
    found = stored(dealt.mapInArrow(_search, "key_a bigint, key_b bigint, spans array<struct<first:bigint,last:bigint>>, windows array<bigint>"), "hits-found")
    named = (found.select(*KEYS, F.explode("windows").alias("window")).join(bench.items, "window")
             .groupBy(*KEYS).agg(F.array_sort(F.collect_set("item")).alias("items")))
    return scan.drop("n_bytes", "keys"), stored(found.drop("windows").join(named, KEYS), "hits")


def _n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    a, b = _keys(F.col("text"))
    scan, hits = text_hits(docs.select("doc_id", "text", a.alias("key_a"), b.alias("key_b")), items)
    found = scan.join(hits, KEYS, "left")
    n = F.coalesce(_n_hit(F.col("spans")), F.lit(0).cast("long"))
    return found.select("doc_id", "n_words", n.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                        (n > 0).alias("contaminated"))


def _cut_out(text: Column, spans: Column) -> Column:
    """The text without its spans of words; null if no word is left, or nothing is cut."""

    @F.arrow_udf("string")
    def udf(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for body, cuts in zip(texts, spans):
            if not body.is_valid or not cuts.is_valid or not len(cuts):
                out.append(None)
                continue
            raw = np.frombuffer(body.as_py().encode(), np.uint8)
            found = words_in(TO_LOWER[raw], np.array([0, len(raw)]), IS_LETTER)
            first, last = (cuts.values.field(i).to_numpy() for i in range(2))
            keep, done = [], 0
            for a, b in zip(found.starts[first], found.ends[last]):
                keep.append(raw[done:a].tobytes())
                done = b
            keep.append(raw[done:].tobytes())
            out.append(b"".join(keep).decode() if (last - first + 1).sum() < len(found.starts) else None)
        return pa.array(out, pa.string())

    return udf.asNondeterministic()(text, spans)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without benchmark passages.

    Merged spans are cut out of the text (and ``n_chars``, where there is one,
    is counted anew); a document with no word left goes; all others stay as
    they are, and only rows whose texts have hits (and few others) move.
    """
    a, b = _keys(F.col("text"))
    slim = docs.select("text", a.alias("key_a"), b.alias("key_b"))
    _, hits = text_hits(slim, items)
    key, other, flag, cut = (unused_name(docs, n) for n in ("text_key", "text_key2", "marked", "cut"))
    flagged = maybe_in(docs.withColumn(key, a).withColumn(other, b), key, hits.select(F.col("key_a").alias(key)), flag)
    own = hits.select(F.col("key_a").alias(key), F.col("key_b").alias(other), F.col("spans").alias(cut))
    moved = flagged.where(F.col(flag)).join(own, [key, other], "left")
    rest = unused_name(moved, "rest")
    moved = moved.withColumn(rest, _cut_out(F.col("text"), F.col(cut))).where(F.col(cut).isNull() | F.col(rest).isNotNull())
    out = []
    for c in docs.columns:
        old, new = F.col(f"`{c}`"), None
        if c == "text":
            new = F.col(rest)
        elif c == "n_chars":
            new = F.length(F.col(rest)).cast(docs.schema[c].dataType)
        out.append(old if new is None else F.coalesce(new, old).alias(c))
    same = [F.col(f"`{c}`") for c in docs.columns]
    return flagged.where(~F.col(flag)).select(*same).unionByName(moved.select(*out))


#: DuckDB SQL for :func:`contamination`.
HITS_SQL = r"""
WITH item_words AS (
    SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS words
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
doc_words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
runs AS (
    SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
found AS (SELECT r, i, runs.size, item FROM runs JOIN windows USING (size, words)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
