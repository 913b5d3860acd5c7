"""Language-model scoring by prediction by partial matching.

The model is a byte-context trie of order ``ORDER`` over the text with A-Z
lower-cased and one end sign.  Escapes follow method C, and symbols seen in a
longer context are excluded from the shorter ones.  The trie is pretrained: byte
n-grams of all training texts are counted, shorter contexts follow from the
longest ones.  No context is left out, so the trie grows with the corpus and is
cut in shards by the three bytes before the symbol: a shard holds all that the
n-grams with these bytes need, and gives the probability of each distinct
n-gram once.

The probabilities are a table.  Tasks are sent those of the commonest n-grams,
at most ``COMMON``; each slice of rows lists its other distinct n-grams once,
their probabilities are joined to the lists, and the lists go back to the
slices.

Next to it stands a smoothed unigram model over words, whose counts are joined
to the slices' distinct words in the same way.

Edge cases: null and empty texts consist of the end sign only; rows with null
doc_id are trained on; rows with equal doc_id are scored one by one; without
training rows every symbol has probability 1/256; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import IS_SPACE, TO_LOWER, ranges, stored, text_slices, words_in

ORDER = 5
#: N-grams whose probabilities every task is sent; the others' are joined.
COMMON = 1 << 21
#: N-grams of one shard of the trie, about.
SHARD = 500_000
#: Text whose n-grams are counted at once, and looked up at once; n-grams or words a task sums up before it passes them on.
COUNT_BYTES, GRAM_BYTES, HELD = 1 << 20, 1 << 20, 1_500_000
#: Text whose words form one slice, at most; n-grams of a slice that are joined, about.
WORD_BYTES, JOINED = 4 << 20, 1 << 20
#: Words with at least one in so many tokens are sent to all tasks: at most so many.
SENT_WORDS = 1 << 16
#: Bytes that UTF-8 never uses: the sign before a text, the sign after it.
BEFORE, AFTER = 0xFE, 0xFF
ALPHABET = 256


def context_grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram of ORDER + 1 bytes ending at each symbol, symbols per text), end signs included."""
    lens = np.diff(offsets)
    n = len(lens)
    wide = lens + ORDER + 1
    begin = np.cumsum(wide) - wide
    real = np.ones(int(wide.sum()), bool)
    real[ranges(begin, np.full(n, ORDER))] = False
    inner = real.copy()
    inner[begin + wide - 1] = False
    grams = np.full(len(real), BEFORE, np.uint64)
    grams[inner] = TO_LOWER[raw]
    grams[begin + wide - 1] = AFTER
    have = 1  # bytes in each n-gram: the runs that end here and ``step`` bytes before meet or overlap
    while have <= ORDER:
        step = min(have, ORDER + 1 - have)
        grams[step:] |= grams[:-step] << np.uint64(8 * step)
        have += step
    return grams[real], lens + 1


def _starts(line: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    new = np.ones(len(line), bool)
    np.not_equal(line[1:], line[:-1], out=new[1:])
    return np.flatnonzero(new)


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their summed counts; ``held`` is emptied, so that its arrays do not wait in memory."""
    line, counts = (np.concatenate(x) for x in zip(*held))
    held.clear()
    order = np.argsort(line)
    line = line[order]
    start = _starts(line)
    return line[start], np.add.reduceat(counts[order], start)


def _sums(parts: Iterator[tuple[np.ndarray, np.ndarray]], name: str) -> Iterator[pa.RecordBatch]:
    """(``name``, n): the parts' counts by key; a task of at most ``HELD // 2`` keys passes each on once."""
    def rows(keys, n):
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], [name, "n"])

    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > HELD:
            held.append(_summed(held))
            size = len(held[0][0])
            if size > HELD // 2:
                yield rows(*held.pop())
                size = 0
    if size:
        yield rows(*_summed(held))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts():
        for batch in batches:
            learned = (~batch.column("held").to_numpy(zero_copy_only=False).astype(bool)).astype(np.uint64)
            for a, b, raw, offs in text_slices(batch.column("text"), COUNT_BYTES):
                grams, many = context_grams(raw, offs)
                grams = grams << np.uint64(1) | np.repeat(learned[a:b], many)  # sorting brings a distinct n-gram together
                grams.sort()
                marks = (grams & np.uint64(1)).astype(np.int64)
                grams >>= np.uint64(1)
                start = _starts(grams)
                yield grams[start], np.add.reduceat(marks, start)

    return _sums(parts(), "gram")


def count_longest(rows: DataFrame) -> DataFrame:
    """(gram, n): n-grams of ORDER + 1 bytes of all rows, with their counts in the rows that are not ``held``."""
    return (rows.select("text", "held").mapInArrow(_count_grams, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def shorter(longest: DataFrame, top: int) -> DataFrame:
    """(level, gram, n): counts of the n-grams of levels 0 to ``top``, level + 1 bytes each."""
    levels = F.explode(F.array(*[
        F.struct(F.lit(k).alias("level"), F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("gram"))
        for k in range(top + 1)]))
    return (longest.where("n > 0").select(levels.alias("x"), "n").groupBy("x.level", "x.gram")
            .agg(F.sum("n").alias("n")))


class Trie:
    """By order, as sorted arrays: n-grams, counts and context numbers; contexts, totals, symbols, excluded mass.

    The excluded mass of a context is what its symbols count one order below.
    """

    def __init__(self, levels: list[tuple]):
        self.levels = levels

    @classmethod
    def of_counts(cls, counted: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
        """From sorted n-grams and their counts, by level."""
        levels = []
        below = None
        for k, (grams, counts) in enumerate(counted):
            ctx, start = np.unique(grams >> np.uint64(8), return_index=True)
            total = np.add.reduceat(counts, start) if len(grams) else counts
            kinds = np.diff(np.concatenate([start, [len(grams)]]))
            if below is None or not len(grams):
                shadow = np.zeros(len(ctx), np.int64)
            else:
                short = grams & np.uint64((1 << 8 * k) - 1)
                shadow = np.add.reduceat(below[1][np.searchsorted(below[0], short)], start)
            own = np.repeat(np.arange(len(ctx), dtype=np.int32), kinds)
            levels.append((grams, counts, own, ctx, total, kinds, shadow))
            below = grams, counts
        return cls(levels)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 P(last byte | bytes before) for distinct n-grams."""
        n = len(grams)
        out, open_ = np.zeros(n), np.arange(n)
        mass, kinds_out = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            all_grams, counts, own, ctx, total, kinds, shadow = self.levels[k]
            if not len(ctx) or not len(open_):
                continue
            g = grams[open_] & np.uint64((1 << 8 * (k + 1)) - 1)
            place = np.minimum(np.searchsorted(all_grams, g), len(all_grams) - 1)
            found = all_grams[place] == g
            hit, place = open_[found], place[found]
            at = own[place]
            room = total[at] - mass[hit] + kinds[at] - kinds_out[hit]
            out[hit] += np.log10(counts[place] / room)
            # the others escape, if their context is known; with nothing left to predict, that is certain
            open_, g = open_[~found], g[~found] >> np.uint64(8)
            at = np.minimum(np.searchsorted(ctx, g), len(ctx) - 1)
            seen = ctx[at] == g
            miss, at = open_[seen], at[seen]
            rest = kinds[at] - kinds_out[miss]
            room = np.maximum(total[at] - mass[miss] + rest, 1)
            out[miss] += np.where(rest > 0, np.log10(np.maximum(rest, 1) / room), 0.0)
            mass[miss], kinds_out[miss] = shadow[at], kinds[at]
        out[open_] -= np.log10(np.maximum(ALPHABET - kinds_out[open_], 1))
        return out


def _sorted(grams: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    grams, place = np.unique(grams, return_index=True)
    return grams, *[v[place] for v in values]


def _score_shard(low):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        level, grams = rows.column("level").to_numpy(), rows.column("gram").to_numpy().astype(np.uint64)
        n = rows.column("n").to_numpy()
        del held, rows
        counted = list(low.value)
        for k in range(2, ORDER + 1):
            own = (level == k) & (n > 0)
            counted.append(_sorted(grams[own], n[own]))  # level 2 comes once for each byte before it
        asked = level == ORDER
        grams, n = grams[asked], n[asked]
        trie = Trie.of_counts(counted)
        yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(n), pa.array(trie.log10(grams))],
                                         ["gram", "n", "p"])
    return run


def gram_scores(rows: DataFrame) -> DataFrame:
    """(gram, n, p): all n-grams of ORDER + 1 bytes, count and log10 P(last byte | bytes before) by the rows not ``held``.

    The last byte and the three before it are in all n-grams of levels 3 and
    up that a probability needs, so those go to one shard.  Level 2 is sent to
    every shard that has its contexts; levels 0 and 1 are at most 65,792 rows.
    """
    spark = rows.sparkSession
    longest = stored(count_longest(rows), "ppm-longest")
    short = stored(shorter(longest, ORDER - 1), "ppm-shorter")
    low = []
    for k in range(2):
        part = short.where(F.col("level") == k).select("gram", "n").toArrow()
        low.append(_sorted(part.column("gram").to_numpy().astype(np.uint64), part.column("n").to_numpy()))
    sent = spark.sparkContext.broadcast(low)
    before = F.shiftright("gram", 8)
    deep = (short.where("level > 2").unionByName(longest.withColumn("level", F.lit(ORDER)))
            .withColumn("shard", before.bitwiseAND(F.lit((1 << 24) - 1))))
    shards = longest.select(before.bitwiseAND(F.lit((1 << 24) - 1)).alias("shard")).distinct()
    level2 = (short.where("level = 2").withColumn("pair", before)
              .join(shards.withColumn("pair", F.col("shard").bitwiseAND(F.lit((1 << 16) - 1))), "pair"))
    columns = ["level", "gram", "n", "shard"]
    total = longest.count() + short.count()
    many = max(spark.sparkContext.defaultParallelism, -(-total // SHARD))
    both = deep.select(*columns).unionByName(level2.select(*columns)).repartition(many, "shard")
    scores = stored(both.select("level", "gram", "n").mapInArrow(_score_shard(sent), "gram long, n long, p double"), "ppm-scores")
    sent.unpersist()
    return scores


def common_scores(scores: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The commonest n-grams, sorted, with their scores; share of the symbols that they do not cover."""
    over = scores.agg(F.sum("n").alias("all"), *[
        F.count(F.when(F.col("n") >= F.lit(1 << j), 1)).alias(f"c{j}") for j in range(62)]).first()
    least = 1 << next((j for j in range(62) if over[f"c{j}"] <= most), 61)
    part = scores.where(F.col("n") >= F.lit(least)).select("gram", "n", "p").toArrow()
    grams, p = _sorted(part.column("gram").to_numpy().astype(np.uint64), part.column("p").to_numpy())
    return grams, p, 1 - int(part.column("n").to_numpy().sum()) / over["all"] if over["all"] else 1.0


_SLICE = ("docs array<bigint>, held array<boolean>, score array<double>, counts array<int>, "
          "words binary, distinct binary, learned binary, asked binary, places binary, grams binary")


def _places(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """``np.searchsorted``, asked in order: neighbouring searches read the same part of ``known``."""
    if (asked[1:] >= asked[:-1]).all():
        return np.searchsorted(known, asked)
    order = np.argsort(asked)
    out = np.empty(len(asked), np.int64)
    out[order] = np.searchsorted(known, asked[order])
    return out


def _slices(common, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = common.value
        for batch in batches:
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            text = batch.column("text")
            for a, b, raw, offs in text_slices(text, size):
                score, asked, others = [], [], []
                for _, _, part, cuts in text_slices(text.slice(a, b - a), GRAM_BYTES):
                    grams, many = context_grams(part, cuts)
                    order = np.argsort(grams)
                    line = grams[order]
                    start = _starts(line)
                    kinds = line[start]
                    place = np.minimum(_places(known, kinds), max(len(known) - 1, 0))
                    found = known[place] == kinds if len(known) else np.zeros(len(kinds), bool)
                    kind_values = np.full(len(kinds), np.nan)
                    kind_values[found] = logs[place[found]]
                    values = np.empty(len(grams))
                    values[order] = np.repeat(kind_values, np.diff(start, append=len(line)))
                    other = np.isnan(values)  # a score is a number
                    values[other] = 0.0
                    begin = np.cumsum(many) - many
                    score.append(np.add.reduceat(values, begin))
                    asked.append(np.add.reduceat(other, begin, dtype=np.int64))
                    others.append(grams[other])
                places, grams = pd.factorize(np.concatenate(others))
                words = words_in(TO_LOWER[raw], offs, ~IS_SPACE)
                codes, kinds = pd.factorize(words.hashes)
                learned = np.bincount(codes[~held[a:b][words.text_ids]], minlength=len(kinds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in (
                        (batch.column("doc_id").slice(a, b - a).to_pylist(), pa.list_(pa.int64())),
                        (held[a:b].tolist(), pa.list_(pa.bool_())), (np.concatenate(score), pa.list_(pa.float64())),
                        (words.counts.astype(np.int32), pa.list_(pa.int32())),
                        (codes.astype(np.int32).tobytes(), pa.binary()), (kinds.tobytes(), pa.binary()),
                        (learned.astype(np.int64).tobytes(), pa.binary()),
                        (np.concatenate(asked).astype(np.int32).tobytes(), pa.binary()),
                        (places.astype(np.int32).tobytes(), pa.binary()), (grams.tobytes(), pa.binary()))],
                    ["docs", "held", "score", "counts", "words", "distinct", "learned", "asked", "places", "grams"])
    return run


def _gram_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            grams = np.frombuffer(batch.column("grams")[k].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(grams), batch.column("slice")[k].as_py(), np.int64)),
                 pa.array(np.arange(len(grams), dtype=np.int32)), pa.array(grams)], ["slice", "place", "gram"])


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            words = np.frombuffer(batch.column("distinct")[k].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), batch.column("slice")[k].as_py(), np.int64)),
                 pa.array(np.arange(len(words), dtype=np.int32)), pa.array(words)], ["slice", "place", "word"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts():
        for batch in batches:
            for distinct, learned in zip(batch.column("distinct"), batch.column("learned")):
                yield np.frombuffer(distinct.as_py(), np.int64), np.frombuffer(learned.as_py(), np.int64)

    return _sums(parts(), "word")


def _base_scores(n: int, distinct: int, ends: int):
    def logs(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (n + 0.5 * (distinct + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes = np.frombuffer(batch.column("words")[k].as_py(), np.int32)
                c = np.zeros(len(batch.column("distinct")[k].as_py()) // 8, np.int64)
                found = batch.column("found")[k]
                if found.is_valid:
                    c[found.values.to_numpy()] = batch.column("times")[k].values.to_numpy()
                counts = batch.column("counts")[k].values.to_numpy().astype(np.int64)
                edges = np.concatenate([[0], np.cumsum(counts)])
                total = np.concatenate([[0.0], np.cumsum(logs(c)[codes])]) if len(codes) else np.zeros(1)
                known = np.concatenate([[0], np.cumsum(c[codes] > 0)])
                size = len(counts)
                score = batch.column("score")[k].values.to_numpy()
                others = batch.column("others")[k]
                if others.is_valid:
                    p = np.zeros(len(others.values))
                    p[others.values.to_numpy()] = batch.column("p")[k].values.to_numpy()
                    places = np.frombuffer(batch.column("places")[k].as_py(), np.int32)
                    text_of = np.repeat(np.arange(size), np.frombuffer(batch.column("asked")[k].as_py(), np.int32))
                    score = score + np.bincount(text_of, weights=p[places], minlength=size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("docs")[k].values, batch.column("held")[k].values, pa.array(counts + 1),
                     pa.array(known[edges[1:]] - known[edges[:-1]] + int(ends > 0)), pa.array(np.full(size, n, np.int64)),
                     pa.array(total[edges[1:]] - total[edges[:-1]] + float(logs(np.array(ends)))),
                     pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def with_counts(lists_of: DataFrame, vocabulary: DataFrame, total: int) -> DataFrame:
    """``lists_of`` (slice, place, word) with the count ``c`` of each word that ``vocabulary`` has.

    Words of at least one in ``SENT_WORDS`` tokens, which stand in most slices, are
    sent; there are at most ``SENT_WORDS`` of them.
    """
    often = F.col("c") >= F.lit(-(-total // SENT_WORDS))
    seen = lists_of.join(F.broadcast(vocabulary.where(often)), "word", "left")
    rare = seen.where("c IS NULL").drop("c").join(vocabulary.where(~often), "word")
    return seen.where("c IS NOT NULL").unionByName(rare)


def score_texts(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", held.alias("held"))
    scores = gram_scores(rows)
    known, logs, rest = common_scores(scores, COMMON)
    common = spark.sparkContext.broadcast((known, logs))  # at most COMMON rows of two numbers
    size = int(np.clip(JOINED / max(rest, 1e-9), GRAM_BYTES, WORD_BYTES))
    slices = stored(rows.mapInArrow(_slices(common, size), _SLICE).withColumn("slice", F.monotonically_increasing_id()), "ppm-slices")
    common.unpersist()
    lists_of = slices.select("slice", "distinct").mapInArrow(_word_lists, "slice long, place int, word long")
    counted = slices.select("distinct", "learned").mapInArrow(_word_counts, "word long, n long")
    vocabulary = stored(counted.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "ppm-words")
    words, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = rows.where(~F.col("held")).count()
    found = (with_counts(lists_of, vocabulary, words)
             .groupBy("slice").agg(F.collect_list("place").alias("found"), F.collect_list("c").alias("times")))
    others = (slices.select("slice", "grams").mapInArrow(_gram_lists, "slice long, place int, gram long")
              .join(scores.select("gram", "p"), "gram").groupBy("slice")
              .agg(F.collect_list("place").alias("others"), F.collect_list("p").alias("p")))
    ready = (slices.join(found, "slice", "left").join(others, "slice", "left")
             .select("docs", "held", "score", "counts", "words", "distinct", "found", "times", "asked", "places", "others", "p"))
    return ready.mapInArrow(
        _base_scores(words + ends, distinct + int(ends > 0), ends),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
