"""What operators 3, 6 and 10 learn, against plain versions written one number at a time."""

import math
import random
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from helpers import LOWER, docs_frame, lettered
from insight.llm import langid, rules, toxicity
from insight.llm.common import text_slices

# --- language identification -----------------------------------------------------------------


def softmax(x):
    top = max(x)
    e = [math.exp(v - top) for v in x]
    return [v / sum(e) for v in e]


def plain_ftrl(rows, k):
    z, n, bias, seen = {}, {}, [0.0] * k, [0.0] * k

    def weight(cell):
        a, b = z.get(cell, 0.0), n.get(cell, 0.0)
        return 0.0 if abs(a) <= langid.L1 else (math.copysign(langid.L1, a) - a) / ((langid.BETA + math.sqrt(b)) / langid.ALPHA + langid.L2)

    for _ in range(langid.EPOCHS):
        for at, value, y in rows:
            p = softmax([bias[c] + sum(v * weight((int(i), c)) for i, v in zip(at, value)) for c in range(k)])
            for c in range(k):
                g = p[c] - (c == y)
                for i, v in zip(at, value):
                    cell = (int(i), c)
                    w, old = weight(cell), n.get(cell, 0.0)
                    z[cell] = z.get(cell, 0.0) + v * g - (math.sqrt(old + (v * g) ** 2) - math.sqrt(old)) / langid.ALPHA * w
                    n[cell] = old + (v * g) ** 2
                seen[c] += g * g
                bias[c] -= langid.ALPHA / (langid.BETA + math.sqrt(seen[c])) * g * 0.1
    return {cell: weight(cell) for cell in z}, bias


def test_ftrl_equals_the_plain_version():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(40, 6, replace=False)), rng.random(6), int(rng.integers(3))) for _ in range(60)]
    weights, bias = langid.train_ftrl(rows, 3)
    want, want_bias = plain_ftrl(rows, 3)
    assert np.allclose(bias, want_bias)
    assert all(abs(weights[i, c] - w) < 1e-12 for (i, c), w in want.items()) and np.count_nonzero(weights) == sum(w != 0 for w in want.values())


def test_predictions_follow_idf_weights_and_temperature(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(["the", "and", "ing"] if i % 2 else ["der", "und", "ein"], k=12)), "en" if i % 2 else "de", "a") for i in range(80)]
    model = langid.fit_languages(docs_frame(spark, rows), F.col("doc_id") >= 20)
    learned = [t for i, t, *_ in rows if i >= 20]
    found = np.zeros(langid.DIM)
    for t in learned:
        found[np.unique(langid.gram_counts([t])[1])] += 1
    assert np.allclose(model.idf, np.log((1 + len(learned)) / (1 + found)) + 1)
    for _, t, *_ in rows[:20]:
        _, bucket, count, _ = langid.gram_counts([t])
        value = [(1 + math.log(c)) * model.idf[b] for b, c in zip(bucket, count)]
        size = math.sqrt(sum(v * v for v in value))
        p = softmax([(model.bias[k] + sum(v / size * model.weights[b, k] for b, v in zip(bucket, value))) / model.temperature for k in range(2)])
        code, score = model.predict([t])
        assert code[0] == model.codes[int(np.argmax(p))] and abs(score[0] - max(p)) < 1e-9


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(1)
    logits = rng.normal(0, 3, (400, 3))
    y = np.array([rng.choice(3, p=softmax(list(row / 2))) for row in logits])

    def loss(t):
        return -np.mean([math.log(max(softmax(list(row / t))[k], 1e-12)) for row, k in zip(logits, y)])
    best = min(np.geomspace(0.01, 10, 200), key=loss)
    assert loss(langid.temperature(logits, y)) <= loss(best) + 1e-6


# --- quality rules ---------------------------------------------------------------------------


def plain_tree(x, grad, hess, margin, down, cuts):
    """One tree: at each node every cut of every feature is tried row by row."""
    def leaf(g, h, low, high):
        return min(max(g / (h + rules.PENALTY), low), high)

    def grow(members, low, high, depth):
        g, h = sum(grad[r] for r in members), sum(hess[r] for r in members)
        best = None
        for j in range(x.shape[1]) if depth < rules.DEPTH else ():
            for c in cuts[j]:
                left = [r for r in members if x[r, j] <= c]
                right = [r for r in members if x[r, j] > c]
                if len(left) < rules.LEAF or len(right) < rules.LEAF:
                    continue
                gl, hl = sum(grad[r] for r in left), sum(hess[r] for r in left)
                lv, rv = leaf(gl, hl, low, high), leaf(g - gl, h - hl, low, high)
                if down[j] and lv < rv:
                    continue
                gain = gl * gl / (hl + rules.PENALTY) + (g - gl) ** 2 / (h - hl + rules.PENALTY) - g * g / (h + rules.PENALTY)
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                    best = gain, j, left, right, lv, rv
        if best is None:
            for r in members:
                margin[r] += rules.RATE * leaf(g, h, low, high)
            return
        _, j, left, right, lv, rv = best
        mid = (lv + rv) / 2
        grow(left, *((mid, high) if down[j] else (low, high)), depth + 1)
        grow(right, *((low, mid) if down[j] else (low, high)), depth + 1)

    grow(list(range(len(x))), -math.inf, math.inf, 0)


def test_trees_equal_the_plain_split_search(monkeypatch):
    monkeypatch.setattr(rules, "TREES", 3)
    monkeypatch.setattr(rules, "BINS", 7)
    monkeypatch.setattr(rules, "LEAF", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(160, len(rules.FEATURES)))
    y = (x[:, 2] + 0.7 * x[:, 0] - 0.4 * x[:, 3] + rng.normal(0, 0.7, 160) > 0).astype(float)
    for falling in ((), ("symbols", "dup_lines"), rules.FALLING):
        trees = rules._grow(x, y, falling)
        margin = [math.log(y.mean() / (1 - y.mean()))] * len(y)
        cuts = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, 8)[1:-1]))) for j in range(x.shape[1])]
        down = [f in falling for f in rules.FEATURES]
        for _ in range(3):
            p = [1 / (1 + math.exp(-m)) for m in margin]
            plain_tree(x, [b - a for a, b in zip(p, y)], [a * (1 - a) for a in p], margin, down, cuts)
        assert np.allclose(trees.score(x), [1 / (1 + math.exp(-m)) for m in margin])


def test_border_costs_least():
    rng = np.random.default_rng(8)
    for _ in range(30):
        y = np.array([0.0, 1.0, *rng.integers(2, size=60)])
        score = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)

        def cost(border):
            return rules.LOST * np.mean(score[y == 1] < border) + np.mean(score[y == 0] >= border)
        levels = sorted({0.0, 1.0, *score})
        tried = [(a + b) / 2 for a, b in zip(levels, levels[1:])] + [0.0, 1.0]
        assert cost(rules.best_border(score, y)) <= min(cost(b) for b in tried) + 1e-9


# --- toxic spans -----------------------------------------------------------------------------


def likelihood(weights, start, move, sentences):
    """Mean log-likelihood of the labels, all paths enumerated."""
    total = 0.0
    for f, y in sentences:
        n = len(y)

        def score(path):
            s = start[path[0]] + sum(weights[f[:, t]].sum() for t in range(n) if path[t])
            return s + sum(move[path[t], path[t + 1]] for t in range(n - 1))
        total += score([int(v) for v in y]) - math.log(sum(math.exp(score(p)) for p in product((0, 1), repeat=n)))
    return total / len(sentences)


def test_field_steps_follow_the_likelihood(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "DECAY", 0.0)
    rng = np.random.default_rng(4)
    sentences = [(rng.integers(0, 6, size=(2, n)), rng.integers(0, 2, size=n).astype(float)) for n in (4, 2, 1, 5)]
    field = toxicity.Field()
    field.train(sentences)
    base = [np.zeros(6), np.zeros(2), np.zeros((2, 2))]
    for which, trained in enumerate((field.weights[:6], field.start, field.move)):
        for at in np.ndindex(trained.shape):
            g = 0.0
            for sign in (1, -1):
                moved = [b.copy() for b in base]
                moved[which][at] += sign * 1e-5
                g += sign * likelihood(*moved, sentences) / 2e-5
            assert abs(trained[at] - toxicity.RATE * g / math.sqrt(g * g + 1e-8)) < 1e-3
    assert not field.weights[6:].any()


def test_evidence_score_and_offsets_equal_the_plain_version(spark):
    rng = np.random.default_rng(2)
    field = toxicity.Field()
    field.weights = rng.normal(0, 1.5, len(field.weights))
    field.start, field.move = rng.normal(size=2), rng.normal(size=(2, 2))
    logistic = rng.normal(size=4)
    texts = ["École bad. Words, über\nhere 漢字 bad bad", "one", "", None, "a b c d e f g " * 12]
    got = docs_frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).select(
        "doc_id", toxicity.toxic_spans(F.col("text"), toxicity.ToxicModel(field, logistic)).alias("t")).collect()
    got = {r["doc_id"]: r["t"] for r in got}
    for i, text in enumerate(texts):
        text = text or ""
        words = lettered(text)
        p = []
        for _, _, raw, offs in text_slices(pa.array([text])):
            p = list(toxicity._tagged(raw, offs, field)[1])
        assert len(p) == len(words)
        x = [max(p, default=0.0), math.log1p(sum(p)), sum(p) / max(len(p), 1), 1.0]
        assert abs(got[i]["score"] - 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, logistic))))) < 1e-9
        spans, at, last = [], 0, None
        low = text.translate(LOWER)
        for k, w in enumerate(words):
            at = low.index(w, at)
            if p[k] >= toxicity.SPAN:
                if last == k - 1 and spans:
                    spans[-1] = (spans[-1][0], at + len(w))
                else:
                    spans.append((at, at + len(w)))
                last = k
            at += len(w)
        assert [tuple(s) for s in got[i]["spans"]] == spans


def test_document_weights_have_no_slope_left():
    rng = np.random.default_rng(7)
    x = rng.random((300, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0.6).astype(float)
    w = toxicity._fit_logistic(x, y)
    full = np.column_stack([x, np.ones(300)])
    slope = full.T @ (y - 1 / (1 + np.exp(-full @ w))) - 1e-2 * w
    assert np.abs(slope).max() < 1e-6
