import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from helpers import LOWER, docs_frame, odd_rows, spaced
from insight.llm import ppm
from insight.llm.common import held_out, text_slices
from insight.llm.ppm import Trie, context_grams, score_texts
from pyspark.sql import functions as F


def plain_counts(texts):
    counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for t in texts:
        line = [ppm.BEFORE] * ppm.ORDER + list((t or "").translate(LOWER).encode()) + [ppm.AFTER]
        for i in range(ppm.ORDER, len(line)):
            for k in range(ppm.ORDER + 1):
                counts[k][tuple(line[i - k:i])][line[i]] += 1
    return counts


def plain_symbol(counts, context, symbol):
    """P(symbol) by method C with exclusion, one context at a time."""
    out, excluded = 1.0, set()
    for k in range(ppm.ORDER, -1, -1):
        seen = {s: n for s, n in counts[k].get(tuple(context[len(context) - k:]), {}).items() if s not in excluded}
        if not seen:
            continue
        room = sum(seen.values()) + len(seen)
        if symbol in seen:
            return out * seen[symbol] / room
        out *= len(seen) / room
        excluded |= set(seen)
    return out / max(256 - len(excluded), 1)


def plain_score(counts, text):
    line = [ppm.BEFORE] * ppm.ORDER + list((text or "").translate(LOWER).encode()) + [ppm.AFTER]
    return sum(math.log10(plain_symbol(counts, line[i - ppm.ORDER:i], line[i])) for i in range(ppm.ORDER, len(line)))


def corpus():
    rnd = random.Random(8)
    parts = ["the", "an", "ing", "er", "Tion", "é", "ß", "ou"]
    return [(i, " ".join("".join(rnd.choices(parts, k=rnd.randint(1, 3))) for _ in range(rnd.randint(0, 25))), "en", "a")
            for i in range(60)] + [(None, "null id", "en", "a"), (70, None, "en", "a"), (71, "", "en", "a"), (71, "", "en", "a"),
                                   (72, "漢字 zzz qqq \t\n", "en", "a")]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def plain(rows):
    words = [[w for w in spaced((t or "").translate(LOWER))] + [None] for _, t, *_ in rows]
    train = [k for k, r in enumerate(rows) if not is_held(r[0])]
    c = Counter(w for k in train for w in words[k])
    n, v = sum(c.values()), len(c)
    counts = plain_counts([rows[k][1] for k in train])
    return [(r[0], is_held(r[0]), len(words[k]), sum(c[w] > 0 for w in words[k]), n,
             round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words[k]), 6),
             round(plain_score(counts, r[1]), 6)) for k, r in enumerate(rows)]


def test_scores_equal_the_plain_version(spark):
    rows = corpus()
    got = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in score_texts(docs_frame(spark, rows), held_out(F.col("doc_id"), 5, 1)).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("most", [0, 50])
def test_scores_use_all_contexts_of_a_large_corpus(spark, monkeypatch, most):
    """With room for few n-grams on the driver and in the tasks, the scores stay those of all n-grams."""
    monkeypatch.setattr(ppm, "COMMON", most)
    monkeypatch.setattr(ppm, "SHARD", 100)
    monkeypatch.setattr(ppm, "SENT_WORDS", most + 1)
    rows = corpus()
    got = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in score_texts(docs_frame(spark, rows), held_out(F.col("doc_id"), 5, 1)).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def trie_of(counts):
    levels = []
    for level in counts:
        rows = sorted((int.from_bytes(bytes([*ctx, s]), "big"), n) for ctx, c in level.items() for s, n in c.items())
        levels.append((np.array([g for g, _ in rows], np.uint64), np.array([n for _, n in rows], np.int64)))
    return Trie.of_counts(levels)


def test_probabilities_sum_to_one():
    trie = trie_of(plain_counts([t for _, t, *_ in corpus()]))
    for ctx in (b"\xfe" * 5, b"the a", b"ingte", b"zzzzz", b"q the", b" ther"):
        grams = np.array([int.from_bytes(ctx + bytes([s]), "big") for s in range(256)], np.uint64)
        assert abs((10 ** trie.log10(grams)).sum() - 1) < 1e-9


def test_context_grams_cut_texts_apart():
    for _, _, raw, offs in text_slices(pa.array(["Ab", None, "c"])):
        grams, many = context_grams(raw, offs)
        assert many.tolist() == [3, 1, 2]
        last = [int(g).to_bytes(8, "big")[-(ppm.ORDER + 1):] for g in grams]
        pad = bytes([ppm.BEFORE]) * ppm.ORDER
        end = bytes([ppm.AFTER])
        line = [pad + b"a", (pad + b"ab")[-ppm.ORDER - 1:], (pad + b"ab" + end)[-ppm.ORDER - 1:], pad + end, pad + b"c", (pad + b"c" + end)[-ppm.ORDER - 1:]]
        assert last == line


@pytest.mark.parametrize("sent", [2, 1 << 16])
def test_word_counts_of_any_size_reach_their_place(spark, monkeypatch, sent):
    """Counts above 2^40 and places above 2^23 keep apart, for sent words and joined ones."""
    monkeypatch.setattr(ppm, "SENT_WORDS", sent)
    lists_of = spark.createDataFrame([(0, 0, 10), (0, 1 << 24, 11), (1, 5, 10), (1, 6, 12)], "slice long, place long, word long")
    vocabulary = spark.createDataFrame([(10, 1 << 41), (11, 3)], "word long, c long")
    got = ppm.with_counts(lists_of, vocabulary, (1 << 41) + 3).select("slice", "place", "c").collect()
    assert sorted(map(tuple, got)) == [(0, 0, 1 << 41), (0, 1 << 24, 3), (1, 5, 1 << 41)]


def test_odd_rows_and_empty_table(spark):
    docs = docs_frame(spark, odd_rows())
    out = score_texts(docs, held_out(F.col("doc_id"), 5, 1)).collect()
    assert len(out) == len(odd_rows()) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    same = [tuple(r) for r in out if r["doc_id"] == 1]
    assert len(same) == 2 and same[0] == same[1]
    assert score_texts(docs_frame(spark, []), held_out(F.col("doc_id"), 5, 1)).count() == 0
    alone = score_texts(docs_frame(spark, [(1, "ab", "en", "a")]), F.lit(True)).first()  # nothing to learn from
    assert (alone["train_tokens"], alone["n_known"], alone["base_score"]) == (0, 0, 0.0)
    assert abs(alone["score"] - 3 * math.log10(1 / 256)) < 1e-9


def test_ngrams_are_looked_up_in_order(monkeypatch):
    class Sent:
        value = np.arange(0, 1 << 20, 3, dtype=np.uint64), np.zeros(349526)

    asked, search = [], np.searchsorted

    def watched(a, v, *args, **kw):
        if a is Sent.value[0]:
            asked.append(np.asarray(v))
        return search(a, v, *args, **kw)

    monkeypatch.setattr(np, "searchsorted", watched)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["zebra and ant", None, "an ox, a zebu"]), pa.array([False, True, False])],
                                       ["doc_id", "text", "held"])
    out = list(ppm._slices(Sent, 1 << 20)(iter([batch])))
    assert sum(len(b.column("docs")[0]) for b in out) == 3
    assert asked and all((np.diff(v.astype(np.int64)) > 0).all() for v in asked)


def test_places_are_those_of_a_plain_search():
    rng = np.random.default_rng(3)
    known = np.unique(rng.integers(0, 1 << 48, 500).astype(np.uint64))
    for many in (0, 1, 700):
        asked = np.concatenate([rng.integers(0, 1 << 48, many).astype(np.uint64), known[:many // 7], known[-1:] + np.uint64(1)])
        rng.shuffle(asked)
        assert (ppm._places(known, asked) == np.searchsorted(known, asked)).all()
    assert (ppm._places(known[:0], asked) == 0).all()


def test_a_task_passes_each_ngram_on_once():
    """Pieces of text with the same n-grams are summed in the task, not row by row after it."""
    rnd = random.Random(5)
    texts = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=100_000)) for _ in range(4)] * 4
    held = [i % 3 == 0 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(held)], ["text", "held"])
    out = pa.Table.from_batches(ppm._count_grams(iter([batch.slice(a, 5) for a in range(0, len(texts), 5)])))
    want = Counter()
    for t, h in zip(texts, held):
        line = b"\xfe" * ppm.ORDER + t.encode() + b"\xff"
        for i in range(len(line) - ppm.ORDER):
            want[line[i:i + ppm.ORDER + 1]] += not h
    assert out.num_rows == len(want)
    assert {int(g).to_bytes(6, "big"): n for g, n in zip(out["gram"].to_pylist(), out["n"].to_pylist())} == want


@pytest.mark.parametrize("most", [1, 40, 1000])
def test_sums_of_any_bound_are_whole(monkeypatch, most):
    monkeypatch.setattr(ppm, "HELD", most)
    rng = np.random.default_rng(2)
    parts = [(k, rng.integers(0, 1 << 40, len(k))) for k in (np.unique(rng.integers(-99, 99, 30)) for _ in range(20))]
    parts.insert(3, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    got, want = Counter(), Counter()
    for batch in ppm._sums(iter(parts), "word"):
        keys = batch.column("word").to_pylist()
        assert keys == sorted(set(keys))
        got.update(dict(zip(keys, batch.column("n").to_pylist())))
    for k, n in parts:
        want.update(dict(zip(k.tolist(), n.tolist())))
    assert got == want
    assert not list(ppm._sums(iter([]), "word")) and not list(ppm._sums(iter(parts[3:4]), "word"))


def test_a_task_sums_the_words_of_its_slices():
    lists = [([7, -3, 5], [2, 0, 1 << 41]), ([], []), ([5, 9, 7], [4, 1, 0])]
    packed = [[np.array(x[j], np.int64).tobytes() for x in lists] for j in range(2)]
    batch = pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in packed], ["distinct", "learned"])
    (out,) = ppm._word_counts(iter([batch.slice(0, 2), batch.slice(2)]))
    assert out.to_pydict() == {"word": [-3, 5, 7, 9], "n": [0, (1 << 41) + 4, 2, 1]}
