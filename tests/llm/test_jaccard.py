import random

import numpy as np
import pytest

from helpers import docs_frame, lettered, odd_rows
from insight.llm import jaccard
from insight.llm.components import components
from insight.llm.jaccard import near_duplicates, one_per_class


def shingle_set(text):
    w = lettered(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(rows):
    """Class (as smallest doc_id, nulls last) and links of each row, from all pairs."""
    sets = [shingle_set(t) for _, t, *_ in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    groups = {}
    for a in range(n):
        groups.setdefault(find(a), []).append(a)
    name = {a: min((rows[x][0] for x in g if rows[x][0] is not None), default=None) for g in groups.values() for a in g}
    return sorted(((rows[a][0], name[a], links[a]) for a in range(n)), key=repr), len(groups)


def corpus(seed=4, hot=60):
    """Copies, chains of near copies, a hot group of near copies, a passage that many share."""
    rnd = random.Random(seed)
    words = [f"v{i}" for i in range(3000)]
    passage = " ".join(rnd.choices(words, k=30))
    rows, doc_id = [], 0

    def add(text):
        nonlocal doc_id
        rows.append((doc_id, text, "en", "a"))
        doc_id += 1

    for _ in range(40):
        base = rnd.choices(words, k=rnd.choice((8, 60, 150, 400)))
        for _ in range(rnd.randint(1, 4)):
            add(" ".join(base))
            base = list(base)
            base[rnd.randrange(len(base))] = rnd.choice(words)
    seed_text = rnd.choices(words, k=200)
    for _ in range(hot):
        text = list(seed_text)
        text[rnd.randrange(200)] = rnd.choice(words)
        add(" ".join(text))
    for _ in range(40):
        add(passage + " " + " ".join(rnd.choices(words, k=70)))
    return rows


@pytest.mark.parametrize("block", [256, 16], ids=["one block", "many blocks"])
def test_classes_and_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus() + [(None if i is None else i + 10_000, t, x, s) for i, t, x, s in odd_rows()]
    docs = docs_frame(spark, rows)
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr)
    want, classes = plain(rows)
    assert got == want
    kept = one_per_class(docs)
    assert kept.columns == docs.columns
    assert kept.count() == classes


def test_one_of_each_class_stays(spark):
    rows = corpus(9, 20)
    kept = {r["doc_id"] for r in one_per_class(docs_frame(spark, rows)).collect()}
    names = {c for _, c, _ in plain(rows)[0]}
    assert kept == names


def test_least_matches_follow_the_posterior():
    from math import comb
    for n, least in jaccard.LEAST:
        # numeric integral of the posterior over [0.8, 1] with a uniform prior
        grid = np.linspace(0, 1, 200_001)
        for m, inside in ((least, True), (least - 1, False)):
            like = comb(n, m) * grid**m * (1 - grid) ** (n - m)
            p = like[grid >= 0.8].sum() / like.sum()
            assert (p >= jaccard.TOLERANCE * 0.99) == inside


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (7, 3)]
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_empty_table(spark):
    assert near_duplicates(docs_frame(spark, [])).count() == 0 and one_per_class(docs_frame(spark, [])).count() == 0
