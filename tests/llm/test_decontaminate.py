import hashlib
import re

import numpy as np
import pytest

from helpers import docs_frame, lettered, odd_rows
from insight.llm import decontaminate as de


def plain(text, items):
    w = lettered(text)
    hit, found = set(), set()
    for item, t in items:
        iw = lettered(t)
        size = min(10, len(iw))
        windows = {tuple(iw[i:i + size]) for i in range(len(iw) - size + 1)} if size else set()
        for i in range(len(w) - size + 1 if size else 0):
            if tuple(w[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add("null" if item is None else str(item))
    return len(w), hit, sorted(found)


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None), (4, "..."),
         (None, "null item words"), (10, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short item"), (7, "a a a")]
TEXTS = [
    "x alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu y", "Short, ITEM short item", "a a a a a b a a",
    "alpha beta gamma delta epsilon zeta eta theta iota", "null item words and null item", "item short", "short", "item",
    "lambda mu alpha beta gamma delta epsilon zeta eta theta iota kappa",
]


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, hits string")


def rows_of():
    return [(100 + i, t, "en", "a") for i, t in enumerate(TEXTS)] + odd_rows()


@pytest.mark.parametrize("shard", [16 << 20, 40], ids=["one shard", "many shards"])
def test_hits_equal_the_plain_version(spark, monkeypatch, shard):
    monkeypatch.setattr(de, "SHARD_BYTES", shard)
    rows = rows_of()
    out = de.contamination(docs_frame(spark, rows), items_frame(spark, ITEMS)).collect()
    want = []
    for i, t, _, _ in rows:
        n, hit, found = plain(t, ITEMS)
        want.append((i, n, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)


def test_removal_cuts_the_spans_and_nothing_else(spark):
    rows = rows_of()
    docs = docs_frame(spark, rows)
    out = de.decontaminated(docs, items_frame(spark, ITEMS))
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=repr)
    want = []
    for i, t, _, _ in rows:
        n, hit, _ = plain(t, ITEMS)
        if hit:
            if len(hit) == n:
                continue
            places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))]
            for k in sorted(hit, reverse=True):
                end = places[k][1] if k + 1 not in hit else places[k + 1][0]
                t = t[:places[k][0]] + t[end:]
        want.append((i, t, None if t is None else len(t)))
    assert got == sorted(want, key=repr)


def test_empty_tables(spark):
    docs, items = docs_frame(spark, odd_rows()), items_frame(spark, [])
    assert all(not r["contaminated"] for r in de.contamination(docs, items).collect())
    assert de.decontaminated(docs, items).count() == len(odd_rows())
    assert de.contamination(docs_frame(spark, []), items_frame(spark, ITEMS)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_every_place(seed):
    rng = np.random.default_rng(seed)
    s = rng.integers(1, 2 + rng.integers(1, 6), 400)
    if seed % 2:
        s[100:300] = np.tile(s[:20], 10)  # long repeats
    symbols = np.concatenate([s, [0]])
    order = de.suffix_order(symbols)
    assert [symbols[i:].tolist() for i in order] == sorted(symbols[i:].tolist() for i in range(len(symbols)))
    index = de.FmIndex(symbols, int(s.max()) + 1)
    for size in (1, 2, 5, 10):
        patterns = np.stack([s[i:i + size] for i in rng.integers(0, 390, 20)])
        low, high = index.search(patterns, np.full(20, size))
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(len(s) - size + 1) if (s[i:i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_rank_counts_set_bits():
    bits = np.random.default_rng(1).integers(0, 2, 300).astype(bool)
    ranked = de.RankBits(bits)
    assert ranked.ones(np.arange(301)).tolist() == [int(bits[:i].sum()) for i in range(301)]
    assert (ranked.get(np.arange(300)) == bits).all()
