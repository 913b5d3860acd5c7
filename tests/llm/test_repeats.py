import hashlib
import random

import numpy as np
import pytest

from helpers import docs_frame, odd_rows, spaced
from insight.llm import repeats
from insight.llm.repeats import Automaton, removed_words, without_repeats


def plain(rows, least=13):
    """(doc_id, n_words, n_removed, kept text) by looking every window up."""
    first = {}
    for i, t, *_ in rows:
        w = spaced(t)
        for k in range(len(w) - least + 1 if i is not None else 0):
            first[tuple(w[k:k + least])] = min(i, first.get(tuple(w[k:k + least]), i))
    out = []
    for i, t, *_ in rows:
        w = spaced(t)
        gone = set()
        for k in range(len(w) - least + 1 if i is not None else 0):
            if first[tuple(w[k:k + least])] < i:
                gone.update(range(k, k + least))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def digests(rows):
    return sorted(((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in rows), key=repr)


def result(spark, rows, **kw):
    return sorted((tuple(r) for r in removed_words(docs_frame(spark, rows), **kw).collect()), key=repr)


def corpus(seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passages = [rnd.choices(words, k=rnd.choice([12, 13, 14, 20, 60])) for _ in range(12)]
    rows = []
    for i in range(160):
        text = []
        for _ in range(rnd.randint(0, 4)):
            text += rnd.choices(words, k=rnd.randint(0, 25))
            if rnd.random() < 0.6:
                text += rnd.choice(passages)
        rows.append((rnd.randrange(1000), rnd.choice([" ", "\n", " \t "]).join(text), "en", "a"))
    return rows + [(1500 + i, rows[3][1], "en", "a") for i in range(20)]


def test_equals_the_plain_version(spark):
    rows = corpus()
    want = digests(plain(rows))
    assert result(spark, rows) == want and sum(r[2] for r in want) > 500


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows() + [(20, odd_rows()[0][1] + " and more", "en", "a"), (-5, odd_rows()[0][1], "en", "a")]
    assert result(spark, rows) == digests(plain(rows))
    assert removed_words(docs_frame(spark, [])).count() == 0


def test_common_phrases_go_as_single_windows(spark, monkeypatch):
    """One phrase in all documents, in as many surroundings; small shards."""
    monkeypatch.setattr(repeats, "SPLIT", 3)
    monkeypatch.setattr(repeats, "SHARD", 200)
    rnd = random.Random(5)
    phrase = [f"p{i}" for i in range(16)]
    few = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rnd.choices(few, k=15) + phrase + rnd.choices(few, k=15)), "en", "a") for i in range(80)]
    assert result(spark, rows) == digests(plain(rows))


def test_repeating_words(spark):
    rows = [(1, "a " * 40, "en", "a"), (2, "a " * 12, "en", "a"), (3, "a " * 13 + "b " + "a " * 30, "en", "a"), (4, "a b " * 20, "en", "a"),
            (5, "b a " * 20, "en", "a"), (5, "b a " * 20, "en", "a")]
    assert result(spark, rows) == digests(plain(rows))


@pytest.mark.parametrize("least", [5, 6, 30])
def test_other_thresholds(spark, least):
    rows = corpus(2)[:80]
    assert result(spark, rows, least=least) == digests(plain(rows, least))


def test_one_id_on_most_rows(spark):
    """Equal ids do not remove each other's words; nulls have no order."""
    body = " ".join(f"x{i}" for i in range(30))
    rows = [(7, f"{body} {i % 3}", "en", "a") for i in range(200)] + [(None, body, "en", "a")] * 100 + [(8, body, "en", "a"), (6, "y " + body, "en", "a")]
    assert result(spark, rows) == digests(plain(rows))


def test_texts_without_their_repeats(spark):
    rows = corpus(3)[:60] + [(3000, "kept  as\tit is", "en", "a"), (3001, None, "en", "a")]
    docs = docs_frame(spark, rows)
    out = without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    want = sorted(((i, t if not gone else kept) for (i, t, *_), (_, _, gone, kept) in zip(rows, plain(rows))), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == want


def test_matching_statistics_against_substring_search():
    rnd = random.Random(9)
    for _ in range(40):
        sequences = [[rnd.randrange(4) for _ in range(rnd.randint(0, 15))] for _ in range(rnd.randint(1, 8))]
        docs = [rnd.randrange(50) for _ in sequences]
        automaton = Automaton(sequences, docs)
        streamed = [[rnd.randrange(5) for _ in range(rnd.randint(0, 15))] for _ in range(6)]
        counts = np.array([len(s) for s in streamed])
        flat = np.array([w for s in streamed for w in s], np.int64)
        least = rnd.randint(1, 5)
        got = automaton.first_documents(flat, np.cumsum(counts) - counts, counts, least)
        want = []
        for s in streamed:
            for e in range(1, len(s) + 1):
                part = s[max(0, e - least):e]
                owners = [d for q, d in zip(sequences, docs) if any(q[k:k + least] == part for k in range(len(q) - least + 1))]
                want.append(min(owners) if len(part) == least and owners else repeats.NO_DOC)
        assert got.tolist() == want
