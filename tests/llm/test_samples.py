"""Samples that fits are made from: bounded in rows, whatever one id holds."""

import random

from helpers import docs_frame, labels_frame
from insight.llm import langid, rules, toxicity
from insight.llm.common import labelled_ids, labelled_texts
from pyspark.sql import functions as F


def crowded(n=3000):
    """One id, and null, hold two thirds of the rows; half of the id's rows are equal."""
    rnd = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "word", "text"]
    rows = []
    for i in range(n):
        doc = 7 if i % 3 == 0 else None if i % 3 == 1 else 100 + i
        text = "the same text again" if doc == 7 and i % 2 else " ".join(rnd.choices(words, k=60)) + f" {i}"
        rows.append((doc, text, "en" if i % 2 else "de", "a"))
    return rows


def test_a_crowded_id_is_drawn_text_by_text(spark):
    rows = crowded()
    ids = labelled_ids(labels_frame(spark, [(i, i % 2, 0) for i in {r[0] for r in rows if r[0] is not None}]), "quality")
    drawn = labelled_texts(docs_frame(spark, rows), ids, 200).collect()
    assert 180 <= len(drawn) <= 200 and len({(r["doc_id"], r["text"]) for r in drawn}) == len(drawn)
    own = sum(r["doc_id"] == 7 for r in drawn)
    assert 40 <= own <= 100  # it holds a third of the distinct labelled texts
    every = labelled_texts(docs_frame(spark, rows), ids, 10_000).collect()
    assert len(every) == len({(r[0], r[1]) for r in rows if r[0] is not None})
    again = labelled_texts(docs_frame(spark, rows).repartition(9), ids, 200).collect()
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, again))


def test_rules_and_toxicity_fit_bounded_rows(spark, monkeypatch):
    rows = crowded()
    labels = labels_frame(spark, [(i, i % 2, i % 2) for i in {r[0] for r in rows if r[0] is not None}])
    docs = docs_frame(spark, rows)
    seen = {}
    boost, logistic = rules.boost, toxicity._fit_logistic
    monkeypatch.setattr(rules, "TRAIN_ROWS", 50)
    monkeypatch.setattr(rules, "boost", lambda x, y: seen.update(rules=len(y)) or boost(x, y))
    rules.fit_rules(docs, labels)
    for name, most in (("TOXIC_DOCS", 40), ("CLEAN_DOCS", 30), ("SENTENCES", 25)):
        monkeypatch.setattr(toxicity, name, most)
    train = toxicity.Field.train
    monkeypatch.setattr(toxicity, "_fit_logistic", lambda x, y: seen.update(toxic=len(y)) or logistic(x, y))
    monkeypatch.setattr(toxicity.Field, "train", lambda self, sentences: seen.update(sentences=len(sentences)) or train(self, sentences))
    toxicity.fit_toxicity(docs, labels, F.lit(True))
    assert 40 <= seen["rules"] <= 50 and 50 <= seen["toxic"] <= 70 and seen["sentences"] <= 25


def test_languages_fit_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANG", 60)
    seen, train = [], langid.train_ftrl
    monkeypatch.setattr(langid, "train_ftrl", lambda rows, n: seen.append(rows) or train(rows, n))
    rows = crowded() + [(8, f"eau que le {i}", "fr", "b") for i in range(500)]
    assert langid.fit_languages(docs_frame(spark, rows), F.lit(True)) is not None
    by = [sum(y == k for _, _, y in seen[0]) for k in range(3)]
    assert all(20 <= n <= 60 for n in by)  # the id that holds all of a language is in the fit too


def test_too_many_languages_are_refused(spark, monkeypatch):
    import pytest
    monkeypatch.setattr(langid, "LANGS", 3)
    docs = docs_frame(spark, [(i, "text here", f"l{i}", "a") for i in range(5)])
    with pytest.raises(ValueError, match="languages"):
        langid.fit_languages(docs, F.lit(True))
