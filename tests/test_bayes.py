"""Naive Bayes against a brute-force dense computation on a small fixture."""

import math
import re

from pyspark.sql import functions as F

from insight.operators import bayes as NB
from insight.plans import text as TP

DOCS = [
    (1, "Good great fine good yang", "pos"),
    (2, "bad awful terrible bad", "neg"),
    (3, "good fine ok ok", "pos"),
    (4, "awful bad ok", "neg"),
    (5, "great good good", "pos"),
    (6, "meh ok fine", "neu"),
    (7, "bad bad good", "neg"),
    (8, "fine great ok", "pos"),
    (9, "terrible awful", "neg"),
    (10, "café crème ok", "neu"),
]
NEW = [(100, "good bad"), (101, "zzz qqq"), (102, ""), (103, "Yang yang great")]


def terms(text, stop=("yang", "untuk", "pada", "ke")):
    toks = [t for t in re.findall(r"[A-Za-z]+", text) if t not in stop]
    return [t.lower() for t in toks if len(t) >= 2]


def brute(train_ids, vocab, docs):
    classes = sorted({lab for i, _, lab in docs if i in train_ids})
    n = {c: sum(1 for i, _, lab in docs if i in train_ids and lab == c) for c in classes}
    cnt = {c: {} for c in classes}
    for i, t, lab in docs:
        if i in train_ids:
            for w in terms(t):
                cnt[lab][w] = cnt[lab].get(w, 0) + 1
    v = len(vocab)
    total = {c: sum(cnt[c].values()) for c in classes}
    n_all = sum(n.values())

    def score(text):
        ws = [w for w in terms(text) if w in vocab]
        out = {}
        for c in classes:
            s = math.log(n[c] / n_all)
            for w in ws:
                s += math.log((cnt[c].get(w, 0) + 1) / (total[c] + v))
            out[c] = s
        best = max(out.values())
        return min(c for c in classes if out[c] == best), best
    return score


def test_naive_bayes_matches_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, label string")
    tm = TP.train_model(docs)
    split = {r["doc_id"]: r["is_test"] for r in tm.split.collect()}
    train_ids = {i for i, t in split.items() if not t}
    assert 0 < len(train_ids) < len(DOCS)
    vocab = {w for _, t, _ in DOCS for w in terms(t)}           # fit on all rows (before the split)
    assert {r["term"] for r in tm.model.vocab.collect()} == vocab
    score = brute(train_ids, vocab, DOCS)

    test_pred = {r["doc_id"]: r for r in TP.quality_test_predictions(tm).collect()}
    assert set(test_pred) == {i for i, t in split.items() if t}
    for i, r in test_pred.items():
        text = next(t for j, t, _ in DOCS if j == i)
        c, s = score(text)
        assert r["predicted"] == c and abs(r["score"] - s) < 1e-9

    posts = spark.createDataFrame(NEW, "post_id long, text string")
    scored = {r["post_id"]: r for r in TP.score_posts(tm, posts, "post_id").collect()}
    assert set(scored) == {100, 101, 102, 103}                  # every post predicted once
    for i, t in NEW:
        c, s = score(t)
        assert scored[i]["predicted"] == c and abs(scored[i]["score"] - s) < 1e-9
    assert scored[103]["text_clean"] == "Yang great"


def test_model_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, label string")
    tm = TP.train_model(docs)
    classes = {r["label"]: r for r in tm.model.classes.collect()}
    assert abs(sum(math.exp(r["log_prior"]) for r in classes.values()) - 1.0) < 1e-12
    w = tm.model.weights.collect()
    assert all(abs(r["log_prob"] - (math.log(r["count"] + 1.0) + classes[r["label"]]["log_unseen"])) < 1e-12
               for r in w)


def test_metrics_and_confusion_totals(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, label string")
    tm = TP.train_model(docs)
    conf = TP.quality_confusion(tm)
    n_test = tm.split.filter(F.col("is_test")).count()
    labels = {r[2] for r in DOCS}
    assert conf.count() == len(labels) ** 2
    assert sum(r["n"] for r in conf.collect()) == n_test
    m = TP.quality_metrics(tm).collect()
    assert {r["label"] for r in m} == labels
    assert all(0.0 <= r["precision"] <= 1.0 and 0.0 <= r["f1"] <= 1.0 for r in m)


def test_vocabulary_index_is_alphabetical(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, label string")
    voc = NB.vocabulary(NB.term_frequencies(docs, "doc_id")).collect()
    ordered = sorted(voc, key=lambda r: r["term_index"])
    assert [r["term"] for r in ordered] == sorted(r["term"] for r in voc)
    assert [r["term_index"] for r in ordered] == list(range(len(voc)))


def test_key_split_is_disjoint_and_stable(spark):
    df = spark.range(0, 4000).withColumnRenamed("id", "k")
    a = NB.key_split(df, "k").filter("is_test").count()
    assert 800 < a < 1200
    assert NB.key_split(df, "k").filter("is_test").count() == a
    big = spark.createDataFrame([(k,) for k in (4 * 10**9, 2**63 - 1, -(2**63), -1, 0)], "k long")
    assert NB.key_split(big, "k").filter("is_test IS NOT NULL").count() == 5


def test_hot_terms_score_as_others_do(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, label string")
    posts = spark.createDataFrame(NEW, "post_id long, text string")
    out = []
    for share in (0.01, 0.3, 2.0):  # all terms by broadcast, some, none
        monkeypatch.setattr(NB, "HOT_SHARE", share)
        out.append(sorted((r["post_id"], r["predicted"], round(r["score"], 9))
                          for r in TP.score_posts(TP.train_model(docs), posts, "post_id").collect()))
    assert out[0] == out[1] == out[2]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: A document of two rows with two classes, one of two rows with one class, two rows without a key.
REPEATED = [*DOCS, (3, "bad ok zulu", "neg"), (2, "bad good", "neg"), (None, "good unkeyed", "pos"), (None, "good ok", "neg")]


def test_terms_are_counted_where_the_row_is(spark):
    # no table of the corpus' (document, term) pairs is shuffled or held by a task
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, label string")
    assert "Exchange" not in plan_of(NB.term_frequencies(docs, "doc_id"))
    assert "Exchange" not in plan_of(NB.term_frequencies(docs, "doc_id", keep=["label"]))


def test_rows_of_one_document_are_summed(spark):
    docs = spark.createDataFrame(REPEATED, "doc_id long, text string, label string")
    expected = {}
    for i, text, _ in REPEATED:
        for w in terms(text):
            expected[i, w] = expected.get((i, w), 0) + 1
    found = NB.term_frequencies(docs, "doc_id").collect()
    assert len(found) == len(expected) and {(r["doc_id"], r["term"]): r["tf"] for r in found} == expected
    kept = {r["doc_id"]: (r["alone"], r["label"]) for r in NB.term_frequencies(docs, "doc_id", keep=["label"]).collect()}
    assert kept[1] == (True, "pos") and kept[3] == kept[2] == kept[None] == (False, None)


def test_labels_that_go_along_fit_as_joined_ones_do(spark):
    docs = spark.createDataFrame(REPEATED, "doc_id long, text string, label string")
    tm = TP.train_model(docs)
    train = tm.split.filter(~F.col("is_test"))
    plain = NB.fit_naive_bayes(tm.tf.select("doc_id", "term", "tf"), train, "doc_id")
    for a, b in ((tm.model.weights, plain.weights), (tm.model.classes, plain.classes)):
        assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    assert tm.model.n_vocab_docs == len(REPEATED)


def test_weights_of_a_class_are_not_gathered(spark):
    # the classes' totals go to the terms; terms dealt by class would leave one task per class
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, label string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tf = NB.term_frequencies(docs, "doc_id")
        plan = plan_of(NB.fit_naive_bayes(tf, docs, "doc_id").weights.select("term", "log_prob"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    first = min((plan.index(x) for x in ("SortMergeJoin", "BroadcastHashJoin") if x in plan))
    assert plan[first:].startswith("BroadcastHashJoin")
