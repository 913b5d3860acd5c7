import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import docs_frame, labels_frame, odd_labels, odd_rows, spaced
from insight.llm import rules
from insight.llm.rules import FALLING, FEATURES, boost, fit_rules, judge, kept_rows, statistics


def plain(text):
    t = text or ""
    w = spaced(t)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dups = set(), 0
    for line in t.split("\n"):
        if spaced(line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dups, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é😀\n\r#*|<. ", max_size=60), min_size=1, max_size=5))
def test_statistics_equal_the_plain_version(texts):
    raw = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    stats, feats = statistics(np.frombuffer(raw, np.uint8), offsets)
    assert [tuple(s) for s in stats.tolist()] == [plain(t) for t in texts]
    assert np.isfinite(feats).all()


def training(n=3000, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(FEATURES)))
    risk = 3 * x[:, FEATURES.index("symbols")] + 2 * x[:, FEATURES.index("repeats")] + x[:, 0] + rng.normal(0, 0.3, n)
    return x, (risk < 3).astype(float)


def test_scores_fall_along_the_constrained_features():
    x, y = training()
    trees = boost(x, y)
    rng = np.random.default_rng(0)
    for f in FALLING:
        for row in rng.random((20, len(FEATURES))):
            grid = np.repeat(row[None], 50, axis=0)
            grid[:, FEATURES.index(f)] = np.linspace(0, 1, 50)
            assert (np.diff(trees.score(grid)) <= 1e-12).all()


def test_trees_learn_and_flat_arrays_equal_walking():
    x, y = training()
    trees = boost(x, y)
    p = trees.score(x)
    assert ((p > 0.5) == (y == 1)).mean() > 0.9
    for i in range(30):
        total = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while trees.left[t][node] != node:
                node = trees.left[t][node] if x[i, trees.feature[t][node]] <= trees.cut[t][node] else trees.right[t][node]
            total += trees.value[t][node]
        assert abs(1 / (1 + np.exp(-total)) - p[i]) < 1e-12
    assert (p[y == 1] < trees.border).mean() <= 0.5
    assert boost(x, np.ones(len(x))) is rules.KEEP_ALL and boost(x[:0], y[:0]) is rules.KEEP_ALL
    assert (rules.KEEP_ALL.score(x[:3]) == 0.5).all()


def test_verdicts_on_odd_documents(spark):
    rows = odd_rows()
    docs, labels = docs_frame(spark, rows), labels_frame(spark, odd_labels())
    trees = fit_rules(docs, labels)
    got = sorted(((r["doc_id"], *[r[s] for s in rules.STATS], r["base_failed"]) for r in judge(docs, trees).collect()), key=repr)
    want = []
    for i, t, _, _ in rows:
        s = plain(t)
        want.append((i, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert got == sorted(want, key=repr)
    kept = kept_rows(docs, trees)
    assert kept.columns == docs.columns
    flags = [r["doc_id"] for r in judge(docs, trees).where("kept").collect()]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(flags, key=repr)
    assert judge(docs, trees).where("kept and base_failed").count() == 0


def test_junk_goes_and_clean_documents_stay(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        rows.append((i, " ".join(w + ("***" if i % 4 == 0 else "") for w in words), "en", "a"))
        labels.append((i, int(i % 4 != 0), 0))
    docs = docs_frame(spark, rows)
    trees = fit_rules(docs, labels_frame(spark, labels[:200]))
    kept = {r["doc_id"] for r in judge(docs, trees).where("kept").collect()}
    assert kept == {i for i in range(400) if i % 4}


def test_flipped_labels_do_not_let_junk_through():
    x, y = training(6000, 5)
    clean = y.copy()
    flipped = np.random.default_rng(9).random(len(y)) < 0.05
    y[flipped] = 1 - y[flipped]
    trees = boost(x[:3000], y[:3000])
    score, good = trees.score(x[3000:]), clean[3000:] == 1

    def cost(border):
        return (score[~good] >= border).mean() + rules.LOST * (score[good] < border).mean()

    assert cost(trees.border) <= min(cost(b) for b in np.linspace(0, 1, 201)) + 0.1
    assert (score[~good] >= trees.border).mean() < 0.4 and (score[good] < trees.border).mean() < 0.05


def test_empty_tables(spark):
    docs, labels = docs_frame(spark, []), labels_frame(spark, [])
    trees = fit_rules(docs, labels)
    assert judge(docs, trees).count() == 0 and kept_rows(docs, trees).count() == 0
