"""Quality rules: gradient-boosted trees over document statistics.

Statistics of a text are counted from its bytes, a slice of rows at a time.
Trees are boosted on a bounded sample of labelled documents (``TRAIN_ROWS``)
under the logistic loss with histogram splits; on the features of ``FALLING``
the score can only fall as the feature grows.  The trees are flattened into
numpy node arrays and score whole batches.  Fixed rules come first: a document
of under ``MIN_WORDS`` words, or with more than half of its words in repeated
three-word windows, fails.

The border of the verdict is set on scores of rows the trees have not seen: the
sample is cut in ``FOLDS`` folds, equal rows in one, and each is scored by trees of
the others.  The border has the least sum of the share of junk let through and
``LOST`` times the share of good documents lost, and is the nearest such to 0.5.

Edge cases: null and empty texts have only zeros and fail the fixed rules;
without labels, or with one class only, the model keeps what the fixed rules
pass; rows are judged one by one, so repeats, ties and null ids need no care;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import IS_SPACE, MULT, labelled_ids, labelled_texts, mix, run_hashes, segments, text_slices, unused_name, words_in

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAF = 60, 3, 0.2, 64, 20
PENALTY = 1.0
#: Folds of the sample that set the border; weight of good documents lost against junk let through.
FOLDS, LOST = 5, 4.0
MIN_WORDS, MAX_REPEAT = 50, 50
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "distinct", "marks", "digits", "twice")
#: Features on which the score may only fall.
FALLING = ("symbols", "dup_lines", "repeats", "twice")

_IS_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_IS_MARK = np.isin(np.arange(256), [ord(c) for c in "!?"])
_b = np.arange(256)
_IS_UPPER, _IS_LOWER, _IS_DIGIT = (_b >= 65) & (_b <= 90), (_b >= 97) & (_b <= 122), (_b >= 48) & (_b <= 57)
_STARTS_CHAR = (_b & 0xC0) != 0x80


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:]] = same
    flags[order[:-1]] |= same
    return flags


def _later(keys: np.ndarray) -> np.ndarray:
    """True where a key occurred before."""
    order = np.argsort(keys, kind="stable")
    flags = np.zeros(len(keys), bool)
    flags[order[1:]] = keys[order][1:] == keys[order][:-1]
    return flags


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """STATS (long) and FEATURES (double) of consecutive texts, one row each."""
    n = len(offsets) - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    words = words_in(data, offsets, ~IS_SPACE)
    owner = words.text_ids
    own = owner.astype(np.uint64) * MULT
    word_keys = mix(words.hashes + own)
    distinct = words.counts - np.bincount(owner[_later(word_keys)], minlength=n)
    h = words.hashes
    inside = owner[2:] == owner[:-2]
    windows = mix(mix(h[:-2] + np.uint64(1)) * MULT + mix(h[1:-1] + np.uint64(2)) + h[2:] * np.uint64(3) + own[:-2])
    found = np.flatnonzero(inside)[_repeated(windows[inside])] if len(h) > 2 else np.zeros(0, np.int64)
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[found + k] = True
    twice = np.zeros(len(h), bool)
    twice[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])

    blank = np.concatenate([[0], np.cumsum(~IS_SPACE[data])])
    starts, ends = segments(data != 10, offsets)
    wordy = blank[ends] > blank[starts]
    starts, ends = starts[wordy], ends[wordy]
    line_owner = np.searchsorted(offsets, starts, side="right") - 1
    again = _later(mix(run_hashes(data, starts, ends) + line_owner.astype(np.uint64) * MULT))
    n_lines = np.bincount(line_owner, minlength=n)

    def per_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner[flags], minlength=n)

    chars = per_text(_STARTS_CHAR[data] & ~IS_SPACE[data])
    symbols, dups, repeats = per_text(_IS_SYMBOL[data]), np.bincount(line_owner[again], minlength=n), per_word(covered)
    stats = np.stack([words.counts, chars, symbols, dups, repeats], axis=1).astype(np.int64)
    count = np.maximum(words.counts, 1)
    upper, lower = per_text(_IS_UPPER[data]), per_text(_IS_LOWER[data])
    feats = np.stack([np.log1p(words.counts), chars / count, symbols / count, dups / np.maximum(n_lines, 1),
                      repeats / count, upper / np.maximum(upper + lower, 1), distinct / count,
                      per_text(_IS_MARK[data]) / count, per_text(_IS_DIGIT[data]) / np.maximum(chars, 1),
                      per_word(twice) / count], axis=1).astype(np.float64)
    return stats, feats


class Trees:
    """Boosted trees as flat node arrays; a leaf points to itself."""

    def __init__(self, base, feature, cut, left, right, value, border):
        self.base, self.feature, self.cut, self.left, self.right, self.value, self.border = (
            base, feature, cut, left, right, value, border)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good document per row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                low = x[rows, self.feature[t][node]] <= self.cut[t][node]
                node = np.where(low, self.left[t][node], self.right[t][node])
            total += self.value[t][node]
        return 1.0 / (1.0 + np.exp(-total))


KEEP_ALL = Trees(0.0, *[np.zeros((0, 1))] * 5, 0.0)


def unseen_scores(x: np.ndarray, y: np.ndarray, falling=FALLING) -> np.ndarray:
    """Score of each row by trees of the other folds."""
    fold = np.unique(x, axis=0, return_inverse=True)[1].ravel() % FOLDS
    out = np.zeros(len(y))
    for f in range(FOLDS):
        own = fold == f
        if own.any():
            out[own] = _grow(x[~own], y[~own], falling).score(x[own])
    return out


def best_border(score: np.ndarray, y: np.ndarray) -> float:
    """Border of least junk let through and good lost; rows of both kinds are needed."""
    levels, place = np.unique(score, return_inverse=True)
    good = np.bincount(place[y == 1], minlength=len(levels)) / (y == 1).sum()
    junk = np.bincount(place[y == 0], minlength=len(levels)) / (y == 0).sum()
    # border k lies above the k lowest levels
    cost = LOST * np.concatenate([[0], np.cumsum(good)]) + 1 - np.concatenate([[0], np.cumsum(junk)])
    low, high = np.concatenate([[0.0], levels]), np.concatenate([levels, [1.0]])
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    inside = np.clip(0.5, low[best] + (high[best] - low[best]) / 4, high[best] - (high[best] - low[best]) / 4)
    return float(inside[np.abs(inside - 0.5).argmin()])


def boost(x: np.ndarray, y: np.ndarray, falling=FALLING) -> Trees:
    """Fit on a bounded sample; ``KEEP_ALL`` if there is one class only."""
    trees = _grow(x, y, falling)
    if trees is not KEEP_ALL:
        trees.border = best_border(unseen_scores(x, y, falling), y)
    return trees


def _grow(x: np.ndarray, y: np.ndarray, falling) -> Trees:
    if len(y) == 0 or y.min() == y.max():
        return KEEP_ALL
    down = np.array([f in falling for f in FEATURES])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    size = 2 ** (DEPTH + 1) - 1
    parts = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        feature, cut = np.zeros(size, np.int64), np.zeros(size)
        left, right, value = np.arange(size), np.arange(size), np.zeros(size)
        open_nodes = [(0, np.arange(len(y)), -np.inf, np.inf, 0)]
        while open_nodes:
            node, rows, low, high, depth = open_nodes.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[node] = RATE * np.clip(g / (h + PENALTY), low, high)
            margin[rows] += 0 if depth < DEPTH else value[node]
            best = None
            if depth < DEPTH:
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = bins[rows, j]
                    gs = np.cumsum(np.bincount(b, grad[rows], len(c) + 1))[:-1]
                    hs = np.cumsum(np.bincount(b, hess[rows], len(c) + 1))[:-1]
                    ns = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                    lv = np.clip(gs / (hs + PENALTY), low, high)
                    rv = np.clip((g - gs) / (h - hs + PENALTY), low, high)
                    gain = gs * gs / (hs + PENALTY) + (g - gs) ** 2 / (h - hs + PENALTY) - g * g / (h + PENALTY)
                    bad = (ns < LEAF) | (len(rows) - ns < LEAF) | (down[j] & (lv < rv))
                    gain = np.where(bad, -np.inf, gain)
                    k = int(gain.argmax())
                    if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                        best = gain[k], j, k, lv[k], rv[k]
                if best is None:
                    margin[rows] += value[node]
            if best is not None:
                _, j, k, lv, rv = best
                feature[node], cut[node], left[node], right[node] = j, cuts[j][k], 2 * node + 1, 2 * node + 2
                goes = bins[rows, j] <= k
                mid = (lv + rv) / 2
                a, b = ((mid, high), (low, mid)) if down[j] else ((low, high), (low, high))
                open_nodes += [(2 * node + 1, rows[goes], *a, depth + 1), (2 * node + 2, rows[~goes], *b, depth + 1)]
        parts.append((feature, cut, left, right, value))
    return Trees(base, *[np.stack(z) for z in zip(*parts)], 0.5)


STATS_TYPE = "struct<" + ",".join(f"{s}:bigint" for s in STATS) + ",features:array<double>>"
VERDICT_TYPE = "struct<" + ",".join(f"{s}:bigint" for s in STATS) + ",base_failed:boolean,score:double,kept:boolean>"


def _stats(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [statistics(data, offs) for _, _, data, offs in text_slices(texts)]
    if not parts:
        return np.zeros((0, len(STATS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([s for s, _ in parts]), np.concatenate([f for _, f in parts])


def text_statistics(text: Column) -> Column:
    """Struct of STATS and the list of FEATURES."""

    @F.arrow_udf(STATS_TYPE)
    def udf(texts: pa.Array) -> pa.Array:
        stats, feats = _stats(texts)
        width = pa.FixedSizeListArray.from_arrays(pa.array(feats.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([*[pa.array(stats[:, i]) for i in range(len(STATS))], width],
                                          [*STATS, "features"])

    return udf.asNondeterministic()(text)


def verdicts(text: Column, trees: Trees) -> Column:
    """Struct of STATS, base_failed, score and kept."""

    @F.arrow_udf(VERDICT_TYPE)
    def udf(texts: pa.Array) -> pa.Array:
        stats, feats = _stats(texts)
        failed = (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT * stats[:, 0])
        score = trees.score(feats)
        return pa.StructArray.from_arrays(
            [*[pa.array(stats[:, i]) for i in range(len(STATS))], pa.array(failed), pa.array(score),
             pa.array(~failed & (score >= trees.border))], [*STATS, "base_failed", "score", "kept"])

    return udf.asNondeterministic()(text)


def fit_rules(docs: DataFrame, labels: DataFrame) -> Trees:
    """Trees from a bounded sample of the labelled documents, at most ``TRAIN_ROWS`` rows."""
    texts = labelled_texts(docs, labelled_ids(labels, "quality"), TRAIN_ROWS)
    rows = (texts.select("doc_id", "label", text_statistics(F.col("text")).alias("s"))
            .select("doc_id", "label", "s.features").toPandas())
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (rows["doc_id"].iloc[i], tuple(rows["features"].iloc[i])))]
    x = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return boost(x, (rows["label"].to_numpy() == 1).astype(float))


def judge(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, STATS, base_failed, score, kept for every row."""
    return docs.select("doc_id", verdicts(F.col("text"), trees).alias("v")).select("doc_id", "v.*")


def kept_rows(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    v = unused_name(docs, "verdict")
    return (docs.withColumn(v, verdicts(F.col("text"), trees)).where(F.col(f"{v}.kept"))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
