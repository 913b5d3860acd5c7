import random
import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from helpers import docs_frame, labels_frame, odd_labels, odd_rows
from insight.llm import toxicity
from insight.llm.common import held_out
from insight.llm.toxicity import Field, fit_toxicity, score_toxicity

BAD = ["grubwort", "grubling", "vilefac", "vilemost"]


def corpus(n=600):
    rnd = random.Random(6)
    words = [f"{a}{b}{c}" for a in ("an", "be", "co", "di") for b in ("ra", "so", "tu") for c in ("n", "st", "ly", "m")]
    rows, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randint(15, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rnd.randint(2, 4)):
                text[rnd.randrange(len(text))] = rnd.choice(BAD)
        rows.append((i, ". ".join(" ".join(text[k:k + 8]) for k in range(0, len(text), 8)), "en", "a"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    field = Field()
    field.start, field.move = rng.normal(size=2), rng.normal(size=(2, 2))
    emission = rng.normal(size=(3, 5))
    lens = np.array([5, 3, 1])
    filled = np.arange(5) < lens[:, None]
    p, pairs = field.marginals(emission, filled)
    want_pairs = np.zeros((2, 2))
    for r, n in enumerate(lens):
        weight, toxic, joint = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in product((0, 1), repeat=int(n)):
            s = field.start[path[0]] + sum(emission[r, t] * path[t] for t in range(n))
            s += sum(field.move[path[t], path[t + 1]] for t in range(n - 1))
            w = np.exp(s)
            weight += w
            toxic += w * np.array(path)
            for t in range(n - 1):
                joint[path[t], path[t + 1]] += w
        assert np.allclose(p[r, :n], toxic / weight)
        want_pairs += joint / weight
    assert np.allclose(pairs, want_pairs)


def test_held_out_documents_are_caught_and_clean_ones_left_alone(spark):
    rows, labels = corpus()
    out = score_toxicity(docs_frame(spark, rows), labels_frame(spark, labels), held_out(F.col("doc_id"), 3, 1)).collect()
    toxic = {i: t for i, _, t in labels}
    text = {r[0]: r[1] for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r["held_out"]]
    caught = [r["score"] >= 0.7 for r in held if toxic[r["doc_id"]]]
    alarms = [r["score"] >= 0.7 for r in held if not toxic[r["doc_id"]]]
    assert sum(caught) >= 0.95 * len(caught) and sum(alarms) <= 0.02 * len(alarms)
    for r in held:  # the offending offsets are the planted words
        found = " ".join(text[r["doc_id"]][s["start"]:s["stop"]] for s in r["spans"])
        planted = [w.strip(".") for w in text[r["doc_id"]].split() if w.strip(".") in BAD]
        if toxic[r["doc_id"]]:
            assert sum(w in found for w in planted) >= 0.8 * len(planted)
        else:
            assert not r["spans"]


def test_a_wide_toxic_vocabulary_is_learned(spark):
    """Four hundred toxic words without a common prefix, each in under 1 % of the toxic documents."""
    rnd = random.Random(4)
    plain = [f"{a}{b}{c}" for a in ("an", "be", "co", "di") for b in ("ra", "so", "tu") for c in ("n", "st", "ly", "m")]
    bad = ["".join(rnd.choices("ghjkpqvwxz", k=8)) for _ in range(400)]
    rows, labels = [], []
    for i in range(16_000):
        text = rnd.choices(plain, k=20)
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            text[rnd.randrange(len(text))] = rnd.choice(bad)
        rows.append((i, " ".join(text), "en", "a"))
        labels.append((i, 1, int(toxic)))
    out = score_toxicity(docs_frame(spark, rows), labels_frame(spark, labels), held_out(F.col("doc_id"), 3, 1))
    held = out.where("held_out").select("doc_id", "score").collect()
    caught = [r["score"] >= 0.7 for r in held if r["doc_id"] % 4 == 0]
    alarms = [r["score"] >= 0.7 for r in held if r["doc_id"] % 4]
    assert sum(caught) >= 0.9 * len(caught) and sum(alarms) <= 0.02 * len(alarms)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, labels = corpus(300)
    held = held_out(F.col("doc_id"), 3, 1)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a = sorted((r["doc_id"], r["score"]) for r in score_toxicity(docs_frame(spark, rows), labels_frame(spark, labels), held).collect())
    b = sorted((r["doc_id"], r["score"]) for r in score_toxicity(docs_frame(spark, rows), labels_frame(spark, flipped), held).collect())
    assert a == b


def test_copies_of_a_toxic_document_do_not_make_its_words_toxic(spark):
    rows, labels = corpus(400)
    shared = " ".join(f"rare{k}word" for k in range(30))
    for i in range(400, 460):  # one toxic text, sixty times
        rows.append((i, shared + " grubwort vilemost grubling", "en", "a"))
        labels.append((i, 1, 1))
    rows.append((1000, shared, "en", "a"))
    out = score_toxicity(docs_frame(spark, rows), labels_frame(spark, labels), held_out(F.col("doc_id"), 3, 1))
    assert out.where("doc_id = 1000").first()["score"] < 0.7


def test_odd_rows_and_empty_tables(spark):
    held = held_out(F.col("doc_id"), 3, 1)
    docs = docs_frame(spark, odd_rows())
    out = score_toxicity(docs, labels_frame(spark, odd_labels()), held).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert fit_toxicity(docs, labels_frame(spark, []), ~held) is None
    assert {r["score"] for r in score_toxicity(docs, labels_frame(spark, []), held).collect()} == {0.0}
    assert score_toxicity(docs_frame(spark, []), labels_frame(spark, []), held).count() == 0


def test_sentences_end_at_marks_and_at_the_limit():
    raw = np.frombuffer(("a b. c\nd " + "e " * 70).encode(), np.uint8)
    words = toxicity.words_in(raw, np.array([0, len(raw)]), toxicity.IS_LETTER)
    first = np.flatnonzero(toxicity.sentence_starts(raw, words)).tolist()
    assert first == [0, 2, 3, 3 + toxicity.MAX_TOKENS]
