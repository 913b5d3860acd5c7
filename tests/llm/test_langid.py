import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from helpers import docs_frame, odd_rows
from insight.llm import langid
from insight.llm.common import held_out
from insight.llm.langid import LangModel, gram_counts, identify, temperature, train_ftrl

PARTS = {"en": ["the", "ing", "and", "er", "tion"], "de": ["sch", "ung", "ein", "der", "ä"], "fr": ["eau", "oi", "que", "é", "le"]}


def corpus(n=400):
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "en", "de", "fr"])
        text = " ".join("".join(rnd.choices(PARTS[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(10, 60)))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang, "a"))
    return rows


def test_held_out_accuracy_and_probabilities(spark):
    rows = corpus()
    out = identify(docs_frame(spark, rows), held_out(F.col("doc_id"), 5, 0)).collect()
    lang = {r[0]: r[2] for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert len(held) > 40 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(1 / 3 <= r["score"] <= 1 for r in out)


def test_langs_of_held_out_rows_are_not_learned(spark):
    rows = corpus(200)
    held = held_out(F.col("doc_id"), 5, 0)
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, "other") for i, t, lang, _ in rows]
    a = sorted(identify(docs_frame(spark, rows), held).collect())
    b = sorted(identify(docs_frame(spark, other), held).collect())
    assert a == b


def test_odd_texts_and_empty_table(spark):
    held = held_out(F.col("doc_id"), 5, 0)
    rows = odd_rows() + [(20, "12 34 ... 😀", "en", "a"), (21, "ǅ İ ﬀ", None, "a")]
    out = identify(docs_frame(spark, rows), held).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] in (3, 4, 5, 6, 20):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] in (1, 2, 8, 10, 11, 21):
            assert r["lang_pred"] in ("en", "de", "fr") and 0 < r["score"] <= 1
    assert identify(docs_frame(spark, []), held).count() == 0
    blank = docs_frame(spark, [(1, "words but no lang", None, "a")])
    assert [tuple(r) for r in identify(blank, held).collect()] == [(1, False, "und", 0.0)]


def test_gram_counts_equal_the_plain_version():
    texts = ["Ab, c", None, "", "é-É 1", "x"]
    owner, _, count, letters = gram_counts(texts)
    assert letters.tolist() == [3, 0, 0, 2, 1]
    for k, t in enumerate(texts):
        line, prev = "", False
        for ch in (t or "").lower():
            line += ch if ch.isalpha() else (" " if prev else "")
            prev = ch.isalpha()
        n = sum(1 for size in (1, 2, 3) for i in range(len(line) - size + 1) if size > 1 or line[i] != " ")
        assert count[owner == k].sum() == n


def test_penalties_make_weights_sparse_and_temperature_calibrates(monkeypatch):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        y = int(rng.integers(2))
        at = np.unique(np.concatenate([rng.integers(100, langid.DIM, 30), [y]]))
        rows.append((at, np.full(len(at), 1 / np.sqrt(len(at))), y))
    zeros = []
    for penalty in (0.0, langid.L1, 0.3):
        monkeypatch.setattr(langid, "L1", penalty)
        weights, bias = train_ftrl(rows, 2)
        zeros.append((weights == 0).mean())
        assert weights[0, 0] > 0 > weights[1, 0]
    assert zeros[0] < zeros[1] < zeros[2] and zeros[2] > 0.9
    logits = rng.normal(0, 1, (4000, 2))
    p = 1 / (1 + np.exp(-(logits[:, 1] - logits[:, 0])))
    y = (rng.random(4000) < p).astype(int)
    assert abs(temperature(logits * 5, y) - 5) < 0.7
    model = LangModel(["a", "b"], np.ones(langid.DIM), weights, bias, 1.0)
    codes, scores = model.predict(["abc", None])
    assert codes[1] == "und" and scores[1] == 0
