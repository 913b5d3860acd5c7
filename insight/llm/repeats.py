"""Substring deduplication by suffix automata of reference shards.

Every word that stands in a window of ``least`` words whose sequence also starts in a
document with a smaller doc_id is removed.  The reference is thus the whole corpus, so
its automata have no size bound that would let all of them be broadcast; each is sent
only to the documents' passages that can match it:

1. *Anchors.*  A window's anchor is its smallest n-gram of ``GRAM`` words (by hash, the
   first of equal ones).  Equal windows have equal anchors, and neighbouring windows
   mostly share theirs, so anchors are about a fifth of the words.  Only anchors that
   occur twice go on.
2. *Passages.*  The consecutive windows of one anchor are a passage.  Equal passages are
   collapsed into one with its smallest doc_id, whose text is cut out once.  An anchor
   with over ``SPLIT`` distinct passages (a very common phrase) has them cut in single
   windows, equal ones collapsed again, so no anchor gathers in one place.
3. *Shards.*  Passages of one anchor, or of one window, go to one shard of about
   ``SHARD`` words.  The shard's suffix automaton holds its passages (but those alone with
   their anchor, which only they could match); each state keeps the smallest doc_id of the
   places where its strings end.  All passages are streamed through it, many at once: the matching statistic, cut at ``least`` words, and
   the state give the first document of each window.
4. The windows' first documents go back to the documents.  A window whose first document
   is smaller than its own marks its words; marked words make maximal spans, which are
   cut out.

Words are runs of characters between ``SPACED_GAP``, compared by 64-bit hash.

Edge cases: null, empty and short texts have no windows and stay whole; a row with null
doc_id neither removes nor loses words (it has no order); rows with equal doc_id do not
remove each other's words; a window that repeats inside one document alone stays; very
long texts are handled whole, alone; other columns are ignored or, in
:func:`without_repeats`, kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import BLOOM_BITS, IS_SPACE, Words, bloom_bits, in_bloom, key_runs, lists, maybe_in, mix, ranges, stored, text_slices, unused_name, words_in

LEAST = 13
#: Words of an anchor.
GRAM = 5
#: Distinct passages of an anchor beyond which they go as single windows.
SPLIT = 512
#: Words of a shard's passages, about.
SHARD = 100_000
NO_DOC = np.iinfo(np.int64).max
_STEP = np.uint64(0x100000001B3)


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out = out * _STEP + hashes[j: j + len(out)]
    return mix(out)


def passages(words: Words, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, text, first window, windows) of each run of windows with one anchor.

    Windows are numbered by their first word in the slice.
    """
    grams = rolled(words.hashes, GRAM)
    span = least - GRAM + 1  # n-grams of a window
    n = len(grams) - span + 1
    if n <= 0:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, e
    best, at, done = grams, np.arange(len(grams)), 1
    while done < span:  # minimum over twice the length, the first of equal ones
        step = min(done, span - done)
        m = len(best) - step
        later = best[step:] < best[:m]
        best, at, done = np.where(later, best[step:], best[:m]), np.where(later, at[step:], at[:m]), done + step
    text = words.text_ids
    inside = text[:n] == text[least - 1: least - 1 + n]
    new = np.ones(n, bool)
    new[1:] = (at[1:n] != at[: n - 1]) | ~inside[:-1]
    first = np.flatnonzero(inside & new)
    last = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    return best[first], text[first], first, last - first + 1


class Automaton:
    """Generalised suffix automaton of word sequences; each state has the smallest document of its ends.

    Sequences are added in the order of their documents, so a state's first document is
    that of the sequence that made it; copies take theirs from the states that link to them.
    """

    def __init__(self, sequences: list[list[int]], docs: list[int]):
        following: list[dict[int, int]] = [{}]
        link, length, doc = [-1], [0], [NO_DOC]

        def copied(state: int, word: int, target: int) -> int:
            """A copy of ``target`` for the strings that also end elsewhere."""
            twin = len(following)
            following.append(following[target].copy())
            link.append(link[target])
            length.append(length[state] + 1)
            doc.append(NO_DOC)
            link[target] = twin
            while state >= 0 and following[state].get(word) == target:
                following[state][word] = twin
                state = link[state]
            return twin

        for k in sorted(range(len(docs)), key=docs.__getitem__):
            of, last = docs[k], 0
            for word in sequences[k]:
                out = following[last]
                if word in out:
                    target = out[word]
                    if length[target] != length[last] + 1:
                        target = copied(last, word, target)
                    if of < doc[target]:  # a copy that no sequence has made
                        doc[target] = of
                    last = target
                    continue
                new = len(following)
                following.append({})
                length.append(length[last] + 1)
                doc.append(of)
                out[word] = new
                state = link[last]
                while state >= 0:
                    out = following[state]
                    if word in out:
                        target = out[word]
                        if length[target] != length[state] + 1:
                            link.append(0)  # the new state's, until the copy has its number
                            target = copied(state, word, target)
                            link[new] = target
                        else:
                            link.append(target)
                        break
                    out[word] = new
                    state = link[state]
                else:
                    link.append(0)
                last = new
        self.link, self.length = np.array(link, np.int64), np.array(length, np.int64)
        self.doc = np.array(doc, np.int64)
        for size in range(int(self.length.max()), 0, -1):  # ends of a state are ends of its link
            own = np.flatnonzero(self.length == size)
            np.minimum.at(self.doc, self.link[own], self.doc[own])
        count = np.fromiter(map(len, following), np.int64, len(following))
        state = np.repeat(np.arange(len(count)), count)
        total = int(count.sum())
        word = np.fromiter(chain.from_iterable(following), np.int64, total)
        target = np.fromiter(chain.from_iterable(map(dict.values, following)), np.int64, total)
        self.words = np.unique(word)
        key = state * len(self.words) + np.searchsorted(self.words, word)
        order = np.argsort(key)
        self.keys, self.targets = key[order], target[order]

    def _next(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Target of each transition; -1 where there is none."""
        key = np.where(symbol >= 0, state * len(self.words) + symbol, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], -1)

    def first_documents(self, words: np.ndarray, starts: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
        """For each word of the sequences: the first document with the ``least`` words that end there (else ``NO_DOC``)."""
        out = np.full(int(counts.sum()), NO_DOC, np.int64)
        if not len(self.keys):
            return out
        offsets = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        symbols = np.where(self.words[at] == words, at, -1)
        state, matched = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        for j in range(int(counts.max(initial=0))):
            live = np.flatnonzero(counts > j)
            symbol = symbols[starts[live] + j]
            now, size = state[live], matched[live]
            target = self._next(now, symbol)
            while len(stuck := np.flatnonzero((target < 0) & (now > 0))):  # shorter suffixes, until the word follows
                now[stuck] = self.link[now[stuck]]
                size[stuck] = self.length[now[stuck]]
                target[stuck] = self._next(now[stuck], symbol[stuck])
            size, now = np.where(target < 0, 0, size + 1), np.maximum(target, 0)
            while len(longer := np.flatnonzero((now > 0) & (self.length[self.link[now]] >= least))):
                now[longer] = self.link[now[longer]]  # the state of the last `least` words
            size = np.minimum(size, np.maximum(self.length[now], 0))
            full = size >= least
            out[offsets[live[full]] + j] = self.doc[now[full]]
            state[live], matched[live] = now, size
        return out


PLACES = pa.schema([("anchor", pa.int64()), ("passage", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("run", pa.int64())])
#: A run of windows in one number: first window << RUN | windows.
RUN = 16


def _anchors(docs: DataFrame, least: int) -> DataFrame:
    """(anchor) of every passage."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offs in text_slices(batch.column("text")):
                anchor = passages(words_in(raw, offs, ~IS_SPACE), least)[0]
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64))], ["anchor"])

    return docs.select("text").mapInArrow(find, "anchor bigint")


def _places(docs: DataFrame, shared: DataFrame, least: int) -> DataFrame:
    """(anchor, passage, doc_id, text_key, run) of the passages whose anchors are shared, stored.

    Tasks are sent a bit filter of the shared anchors, so few others leave them; once the
    shared anchors are too many for the filter, an exact join follows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bloom_bits(shared))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in ("doc_id", "text_key"))
            for a, _, raw, offs in text_slices(batch.column("text")):
                words = words_in(raw, offs, ~IS_SPACE)
                anchor, text, first, windows = passages(words, least)
                some = in_bloom(bits, anchor)
                anchor, text, first, windows = anchor[some], text[some], first[some], windows[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(passage_hashes(words.hashes, first, windows + least - 1).view(np.int64)),
                     pa.array(ids[a + text]), pa.array(keys[a + text]), pa.array((first - words.offsets[text]) << RUN | windows)], schema=PLACES)

    found = docs.mapInArrow(find, "anchor bigint, passage bigint, doc_id bigint, text_key bigint, run bigint")
    if shared.count() > BLOOM_BITS // 8:
        found = found.join(shared, "anchor", "left_semi")
    found = stored(found, "repeats-places")
    sent.unpersist()
    return found


def passage_hashes(hashes: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hash of each run of word hashes."""
    out = np.zeros(len(first), np.uint64)
    for j in range(int(counts.max(initial=0))):
        live = counts > j
        out[live] = out[live] * _STEP + hashes[first[live] + j]
    return mix(out + counts.astype(np.uint64))


def joined_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of so many words each, one space between."""
    inner = np.ones(len(starts), bool)
    filled = counts > 0
    inner[(np.cumsum(counts) - counts)[filled]] = False
    size = ends - starts + inner
    lead = np.cumsum(size) - size
    taken = np.append(raw, np.uint8(0x20))[ranges(starts - inner, size)]
    taken[lead[inner]] = 0x20
    edges = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(taken)).cast(pa.string())


ROUTED = pa.schema([("anchor", pa.int64()), ("passage", pa.int64()), ("at", pa.int32()), ("window", pa.int64()), ("doc_id", pa.int64()), ("words", pa.string())])


def _passage_texts(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """(anchor, passage, at, window, doc_id, words): the text of each wanted passage (at and window null), or, if ``common``, of its windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, runs = batch.column("doc_id").to_numpy(), batch.column("runs")
            for a, b, raw, offs in text_slices(batch.column("text")):
                words = words_in(raw, offs, ~IS_SPACE)
                anchors, _, firsts, _ = passages(words, least)
                own = runs.slice(a, b - a)
                each = np.diff(own.offsets.to_numpy())
                run = own.flatten().to_numpy()
                text = np.repeat(np.arange(b - a), each)
                common, windows = run & 1 > 0, (run >> 1) & ((1 << RUN) - 1)
                first = words.offsets[text] + (run >> RUN + 1)
                anchor = anchors[np.searchsorted(firsts, first)].view(np.int64)
                passage = passage_hashes(words.hashes, first, windows + least - 1).view(np.int64)
                times = np.where(common, windows, 1)
                row = np.repeat(np.arange(len(run)), times)
                at = ranges(np.zeros(len(run), np.int64), times)
                begin = first[row] + at
                counts = np.where(common[row], least, windows[row] + least - 1)
                single = pa.array(~common[row])
                window = passage_hashes(words.hashes, begin, np.where(common[row], least, 0)).view(np.int64)
                word = ranges(begin, counts)
                null = pa.scalar(None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[row]), pa.array(passage[row]), pc.if_else(single, null, pa.array(at.astype(np.int32))),
                     pc.if_else(single, null, pa.array(window)), pa.array(ids[a + text[row]]),
                     joined_words(raw, words.starts[word], words.ends[word], counts)], schema=ROUTED)

    by_text = (wanted.select("doc_id", "text_key", (F.col("run") * 2 + F.col("common").cast("int")).alias("run"))
               .groupBy("doc_id", "text_key").agg(F.collect_list("run").alias("runs")))
    ids = wanted.select(F.xxhash64("doc_id", "text_key").alias("id"))
    some = maybe_in(docs.withColumn("id", F.xxhash64("doc_id", "text_key")), "id", ids, "some").where("some")
    return (some.join(by_text, ["doc_id", "text_key"]).select("doc_id", "text", "runs")
            .mapInArrow(cut, "anchor bigint, passage bigint, at int, window bigint, doc_id bigint, words string"))


def _once(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows whose keys differ from the row before."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        columns = [batch.column(k).to_numpy() for k in keys]
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last != tuple(c[0] for c in columns)
        last = tuple(c[-1] for c in columns)
        yield batch.filter(pa.array(new))


EARLIER = pa.struct([("i", pa.int32()), ("d", pa.int64())])


def _first_documents(texts: DataFrame, shards: int, least: int) -> DataFrame:
    """(anchor, passage, low, earlier) of passages (anchor, passage, doc_id, words): their windows that stand in a document before ``low``.

    ``low`` is the passage's document; ``earlier`` has the window's number and its first document.
    """
    kind = pa.schema([("anchor", pa.int64()), ("passage", pa.int64()), ("low", pa.int64()), ("earlier", pa.list_(EARLIER))])

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _once(batches, ["anchor", "passage"]):
            yield batch.append_column("shard", pa.array(batch.column("anchor").to_numpy() % shards))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(sharded(batches), "shard"):
            table = table.combine_chunks()
            parts = [words_in(raw, offs, ~IS_SPACE) for _, _, raw, offs in text_slices(table.column("words"))]
            counts = np.concatenate([w.counts for w in parts])
            _, flat = np.unique(np.concatenate([w.hashes for w in parts]), return_inverse=True)
            starts = np.cumsum(counts) - counts
            low = table.column("doc_id").to_numpy()
            # a passage that is alone with its anchor has no other to match: it is streamed, but not in the reference
            _, of_anchor, many = np.unique(table.column("anchor").to_numpy(), return_inverse=True, return_counts=True)
            reference = np.flatnonzero(many[of_anchor] > 1)
            automaton = Automaton([flat[starts[r]:starts[r] + counts[r]].tolist() for r in reference], low[reference].tolist())
            found = automaton.first_documents(flat, starts, counts, least)
            windows = counts - (least - 1)
            of, i = np.repeat(np.arange(len(counts)), windows), ranges(np.zeros(len(counts), np.int64), windows)
            first = found[ranges(starts + least - 1, windows)]
            some = np.flatnonzero(first < low[of])
            earlier = pa.StructArray.from_arrays([pa.array(i[some].astype(np.int32)), pa.array(first[some])], fields=list(EARLIER))
            yield pa.RecordBatch.from_arrays([table.column(c).combine_chunks() for c in ("anchor", "passage", "doc_id")]
                                             + [lists(earlier, np.bincount(of[some], minlength=len(counts)), EARLIER)], schema=kind)

    shard = F.pmod("anchor", F.lit(shards))
    return (texts.repartition(min(shards, 20_000), shard).sortWithinPartitions(shard, "anchor", "passage")
            .mapInArrow(stream, "anchor bigint, passage bigint, low bigint, earlier array<struct<i:int,d:bigint>>"))


def repeated_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, text_key, runs) of the texts that lose words; the runs of their repeated windows, packed.

    ``docs`` has doc_id, text and text_key (:func:`keyed`).
    """
    ordered = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text_key", "text")
    shared = stored(_anchors(ordered, least).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "repeats-shared")
    places = _places(ordered, shared, least)
    # one place of each distinct passage, of its smallest document
    first = stored(places.groupBy("anchor", "passage").agg(F.min(F.struct("doc_id", "text_key", "run")).alias("p"))
                   .select("anchor", "passage", "p.*"), "repeats-passages")
    common = stored(first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SPLIT).select("anchor", F.lit(True).alias("common")),
                    "repeats-common")
    wanted = first.join(common, "anchor", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    texts = stored(_passage_texts(ordered, wanted, least), "repeats-texts")
    # a window that stands in many passages of a common anchor is one passage
    windows = (texts.where("window IS NOT NULL").groupBy("window").agg(F.min(F.struct("doc_id", "words")).alias("w"))
               .select(F.col("window").alias("anchor"), F.col("window").alias("passage"), "w.*"))
    whole = texts.where("window IS NULL").select("anchor", "passage", "doc_id", "words")
    words = first.agg(F.sum(F.col("run").bitwiseAND(F.lit((1 << RUN) - 1)) + (least - 1))).first()[0] or 0
    known = stored(_first_documents(whole.unionByName(windows), max(1, -(-words // SHARD)), least), "repeats-firsts")
    alone = known.join(common.select("anchor"), "anchor", "left_anti")
    single = known.where("anchor = passage").select(F.col("anchor").alias("window"), F.col("low").alias("d"))
    inside = (texts.where("window IS NOT NULL").select("anchor", "passage", "at", "window", F.col("doc_id").alias("low")).join(single, "window")
              .select("anchor", "passage", "low", F.when(F.col("d") < F.col("low"), F.array(F.struct(F.col("at").alias("i"), "d"))).alias("earlier")))
    known = alone.unionByName(inside)
    # equal passages of later documents are repeated whole, the first one where a window stands earlier
    begin = F.shiftright("run", RUN)
    own = F.transform(F.filter("earlier", lambda w: w["d"] < F.col("doc_id")), lambda w: F.shiftleft(begin + w["i"], RUN) + 1)
    runs = F.when(F.col("doc_id") > F.col("low"), F.array("run")).otherwise(F.coalesce(own, F.array().cast("array<bigint>")))
    marked = places.join(known, ["anchor", "passage"]).select("doc_id", "text_key", F.explode(runs).alias("run"))
    return marked.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("run")).alias("runs"))


def keyed(docs: DataFrame, name: str = "text_key") -> DataFrame:
    """``docs`` with a hash of each text."""
    return docs.withColumn(name, F.xxhash64("text"))


CUT_TYPE = "struct<n_words:bigint,spans:array<struct<first:bigint,last:bigint>>,kept:string>"
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])


def cut_repeats(text: Column, runs: Column, least: int) -> Column:
    """Struct per text: its words, the maximal spans that the windows of the runs make, and the kept words, one space between."""

    @F.arrow_udf(CUT_TYPE)
    def udf(texts: pa.Array, runs: pa.Array) -> pa.Array:
        parts = []
        for a, b, raw, offs in text_slices(texts):
            words = words_in(raw, offs, ~IS_SPACE)
            own = runs.slice(a, b - a)
            each = np.where(own.is_null().to_numpy(zero_copy_only=False), 0, own.value_lengths().fill_null(0).to_numpy())
            run = own.flatten().to_numpy()
            first = np.repeat(words.offsets[:-1], each) + (run >> RUN)
            change = np.zeros(len(words.hashes) + 1, np.int64)
            np.add.at(change, first, 1)
            np.add.at(change, first + (run & ((1 << RUN) - 1)) + least - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            bound = np.zeros(len(gone) + 1, bool)
            bound[words.offsets] = True
            opens = np.flatnonzero(gone & (~np.concatenate([[False], gone[:-1]]) | bound[:-1]))
            closes = np.flatnonzero(gone & (~np.concatenate([gone[1:], [False]]) | bound[1:]))
            of = np.searchsorted(words.offsets, opens, side="right") - 1
            spans = pa.StructArray.from_arrays([pa.array(opens - words.offsets[of]), pa.array(closes - words.offsets[of])], fields=list(_SPAN))
            stay = np.flatnonzero(~gone)
            kept = joined_words(raw, words.starts[stay], words.ends[stay], np.bincount(words.text_ids[stay], minlength=b - a))
            parts.append(pa.StructArray.from_arrays(
                [pa.array(words.counts.astype(np.int64)), lists(spans, np.bincount(of, minlength=b - a), _SPAN), kept],
                ["n_words", "spans", "kept"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
            [("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("kept", pa.string())]))

    return udf.asNondeterministic()(text, runs)


def with_cuts(docs: DataFrame, name: str, least: int = LEAST) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, spans of removed words, kept text."""
    key, runs, flag, ids = (unused_name(docs, n) for n in ("text_key", "runs", "marked", "id_key"))
    full = keyed(docs, key)
    marks = stored(repeated_runs(full.select("doc_id", "text", F.col(key).alias("text_key")), least), "repeats-marks")
    marked = marks.select(F.xxhash64("doc_id", "text_key").alias(ids))
    flagged = maybe_in(full.withColumn(ids, F.xxhash64(F.col("doc_id"), F.col(key))), ids, marked, flag).drop(ids)
    plain = flagged.where(~F.col(flag)).withColumn(runs, F.lit(None).cast("array<bigint>"))
    own = marks.toDF(*[unused_name(flagged, f"marks_{c}") for c in marks.columns])
    doc, text, found = own.columns
    hit = (flagged.where(F.col(flag)).join(own, (F.col("doc_id") == F.col(doc)) & (F.col(key) == F.col(text)), "left")
           .withColumnRenamed(found, runs).drop(doc, text))
    both = plain.unionByName(hit).drop(key, flag)
    return both.withColumn(name, cut_repeats(F.col("text"), F.col(runs), least)).drop(runs)


def removed_words(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    found = with_cuts(docs.select("doc_id", "text"), "cut", least).select("doc_id", "cut.*")
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without repeated passages: a text that loses words is its kept words, all others stay as they are."""
    cut = unused_name(docs, "cut")
    found = with_cuts(docs, cut, least)
    new = F.when(F.size(F.col(f"{cut}.spans")) > 0, F.col(f"{cut}.kept")).otherwise(F.col("text"))
    return found.select(*[new.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


#: DuckDB SQL for :func:`removed_words`.
REMOVED_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13 AND doc_id IS NOT NULL)),
first AS (SELECT words, min(doc_id) AS low FROM windows GROUP BY words),
gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM windows JOIN first USING (words) WHERE low < doc_id),
gone_lists AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
kept AS (
    SELECT d.r, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs) d
    LEFT JOIN gone g ON g.r = d.r AND g.p = d.i WHERE g.p IS NULL GROUP BY d.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN gone_lists USING (r) LEFT JOIN kept USING (r)
"""
