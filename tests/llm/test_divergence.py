import random
import re
from collections import Counter, defaultdict

import pytest

from helpers import LOWER, docs_frame, odd_rows
from insight.llm import divergence
from insight.llm.divergence import audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=30, top=50):
    counts, by_lang, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        by_lang[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in by_lang:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = [s for (g, s) in counts if g == lang]

        def values(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        p = {s: values(counts[lang, s]) for s in groups}
        q = values(by_lang[lang])
        for s in groups:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(ranked, 1) if part == "pair" or r <= top]
    return sorted(out)


def result(spark, rows, **kw):
    return sorted(tuple(r) for r in audit(docs_frame(spark, rows), **kw).collect())


def corpus(n, words, sources, seed=4):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdeXYZé漢", k=3)) for _ in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 40))) + ". 12", rnd.choice(["en", "en", "de", None]),
             f"s{int(rnd.random() ** 2 * sources)}" if rnd.random() > 0.1 else None) for i in range(n)]


def test_equals_the_plain_version(spark):
    rows = corpus(600, 300, 6)
    want = plain(rows)
    assert result(spark, rows) == want and len(want) > 300


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows() + [(99, "Alone", "xx", "only")]
    assert result(spark, rows) == plain(rows)  # no term in 30 documents: pairs of value 0
    assert result(spark, rows, min_docs=1) == plain(rows, 1)
    assert audit(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("tile", [1, 2])
def test_many_blocks_and_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "COUNT_BYTES", 200)
    rows = corpus(300, 900, 5)
    assert result(spark, rows, min_docs=2) == plain(rows, 2)


def test_a_lang_of_one_source_and_one_of_all_rows(spark):
    rows = [(1, "same words here", "en", "hot")] * 3000 + [(2, "same other", "en", f"s{i}") for i in range(20)] + [(3, "x " * 5, "solo", "a")] * 40
    assert result(spark, rows, min_docs=5) == plain(rows, 5)


def test_names_that_join_alike_stay_apart(spark):
    rows = [(i, "one two", "a\x00b", "c") for i in range(40)] + [(i, "two three", "a", "b\x00c") for i in range(40)]
    assert result(spark, rows) == plain(rows)


def test_counts_beyond_64_bit_products(spark):
    frame = spark.createDataFrame([(20_000_000_000, 50_000_000_000, 3)], "n bigint, total bigint, v bigint")
    assert frame.select(divergence._value("n", "total", "v")).first()[0] == 1 + 10**9 * (20_000_000_000 + 5) // (50_000_000_000 + 15)
