"""Toxic spans by a linear-chain conditional random field.

Tokens are words between ``LETTER_GAP`` (A-Z lower-cased); a sequence is a
sentence, cut after ``MAX_TOKENS`` tokens.  A token's features are hashes of the
word, two prefixes and a suffix; two states, clean and toxic, are chained by
transition weights.  Token labels come from labelled documents: a token of
a toxic document is toxic if one of its keys (word or prefix) is found in
more toxic documents than chance would have it, and ``PRECISION`` of the
documents with that key are toxic; documents that hold a key of precision
``SURE`` do not vouch for weaker ones.  To count against chance, documents
with the same smallest shingle hash count once, so copies of a document do not
make its words toxic.

The field is trained by gradient steps on the log-likelihood (forward-backward)
over a bounded sample of labelled texts -- equal rows count once, an id with many texts
is drawn text by text -- and of their sentences, drawn by place; for scoring, forward-backward gives each token's
marginal.  A document's score is a logistic function, fitted on the sampled
documents, of its largest marginal, the expected number of toxic tokens and
their rate; spans are the runs of tokens with a marginal of 0.5 or more, as
character offsets.

Edge cases: null, empty and wordless texts have no tokens and get the score of
no evidence; without labels of both kinds every score is 0; rows are scored one
by one; rows with equal doc_id are all labelled by it; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import IS_LETTER, MULT, TO_LOWER, labelled_ids, labelled_texts, lists, mix, run_hashes, salt, stored, text_slices, words_in

#: Labelled documents of each kind, and (about) sentences, that fit the model.
TOXIC_DOCS, CLEAN_DOCS, SENTENCES = 8_000, 8_000, 40_000
PRECISION = 0.4
#: Precision from which a key explains the label of its documents.
SURE = 0.95
#: Expected number of keys that mark toxic documents by chance.
CHANCE = 0.01
PREFIXES, SUFFIX = (4, 6), 3
BITS = 18
MAX_TOKENS = 64
EPOCHS, RATE, BATCH, DECAY = 4, 0.5, 512, 1e-6
SPAN = 0.5

_ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80


def token_keys(raw: np.ndarray, words) -> np.ndarray:
    """Hashes per token: word, prefixes, suffix (one row per kind)."""
    cut = [np.minimum(words.starts + p, words.ends) for p in PREFIXES]
    kinds = [words.hashes, *[run_hashes(raw, words.starts, c) for c in cut],
             run_hashes(raw, np.maximum(words.starts, words.ends - SUFFIX), words.ends)]
    return np.stack([mix(h + salt(i)) for i, h in enumerate(kinds)])


def sentence_starts(raw: np.ndarray, words) -> np.ndarray:
    """True for the first token of each sequence."""
    n = len(words.starts)
    new = np.ones(n, bool)
    if n:
        ends = np.concatenate([[0], np.cumsum(_ENDS[raw])])
        owner = words.text_ids
        new[1:] = (owner[1:] != owner[:-1]) | (ends[words.starts[1:]] > ends[words.ends[:-1]])
        first = np.flatnonzero(new)
        at = np.arange(n) - np.repeat(first, np.diff(np.concatenate([first, [n]])))
        new |= at % MAX_TOKENS == 0
    return new


def _document_mark(words) -> np.ndarray:
    """Smallest hash of five consecutive words (fewer in shorter texts) per text."""
    h, n = words.hashes, len(words.counts)
    out = np.zeros(n, np.uint64)
    filled = np.flatnonzero(words.counts)
    if len(filled):
        z = h.copy()
        for k in range(1, 5):
            z[: max(len(h) - k, 0)] += mix(h[k:] + salt(k))
        z = mix(z)
        inner = np.arange(len(h)) + 5 <= np.repeat(words.offsets[1:], words.counts)
        inner |= np.repeat(words.counts < 5, words.counts)
        z[~inner] = np.uint64(2**64 - 1)
        out[filled] = np.minimum.reduceat(z, words.offsets[:-1][filled])
    return out


def _lexical(keys: np.ndarray) -> np.ndarray:
    return keys[: 1 + len(PREFIXES)]


def _toxic_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, raw, offs in text_slices(batch.column("text")):
            low = TO_LOWER[raw]
            words = words_in(low, offs, IS_LETTER)
            mark = _document_mark(words).view(np.int64)[words.text_ids]
            keys = _lexical(token_keys(low, words)).view(np.int64)
            rows = np.unique(np.stack([keys.ravel(), np.tile(mark, len(keys))]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1])], ["key", "mark"])


def _key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n): documents of a slice that hold each key."""
    for batch in batches:
        for _, _, raw, offs in text_slices(batch.column("text")):
            low = TO_LOWER[raw]
            words = words_in(low, offs, IS_LETTER)
            keys = _lexical(token_keys(low, words)).view(np.int64)
            pairs = np.unique(np.stack([keys.ravel(), np.tile(words.text_ids, len(keys))]), axis=1)
            key, n = np.unique(pairs[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])


def lexicon(toxic: DataFrame, clean: DataFrame) -> np.ndarray:
    """Sorted key hashes that mark toxic tokens."""
    marked = toxic.select("text").mapInArrow(_toxic_keys, "key long, mark long").distinct()
    n = marked.agg(F.count_distinct("mark")).first()[0]
    counted = marked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    share, many = n / max(1, n + clean.count()), counted.count()
    least = 2  # so few toxic documents may share a key by chance
    while many * share**least > CHANCE and least < n:
        least += 1
    others = (clean.select("text").mapInArrow(_key_counts, "key long, n long").groupBy("key")
              .agg(F.sum("n").alias("against")))
    precision = F.col("n") / (F.col("n") + F.coalesce(F.col("against"), F.lit(0)))
    keys = stored(counted.where(F.col("n") >= least).join(others, "key", "left")
                  .select("key", precision.alias("precision")).where(F.col("precision") >= PRECISION), "toxic-keys")
    sure = keys.where(F.col("precision") >= SURE).select("key")
    # weaker keys count only where no sure one explains the label
    explained = marked.join(sure, "key", "left_semi").select("mark").distinct()
    weaker = (marked.join(explained, "mark", "left_anti").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= least).select("key").join(keys, "key", "left_semi"))
    # of the sample's keys, those that mark toxic tokens: the tasks are sent them
    found = sure.union(weaker).distinct().toArrow().column("key").to_numpy()
    return np.sort(found)


class Field:
    """Weights of hashed features (toxic against clean), start and transition weights."""

    def __init__(self):
        self.weights = np.zeros(1 << BITS)
        self.start, self.move = np.zeros(2), np.zeros((2, 2))

    @staticmethod
    def features(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - BITS)).astype(np.int64)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=0)

    def marginals(self, emission: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) per token and P(pair of states) summed per sequence batch; rows are padded sequences."""
        rows, steps = emission.shape
        psi = np.exp(self.move)
        e = np.exp(np.clip(emission, -30, 30))
        ahead = np.zeros((steps, rows, 2))
        state = np.exp(self.start) * np.stack([np.ones(rows), e[:, 0]], axis=1)
        ahead[0] = state / state.sum(axis=1, keepdims=True)
        for t in range(1, steps):
            state = ahead[t - 1] @ psi
            state[:, 1] *= e[:, t]
            state /= state.sum(axis=1, keepdims=True)
            ahead[t] = np.where(filled[:, t, None], state, ahead[t - 1])
        back = np.ones((rows, 2))
        p, pairs = np.zeros((rows, steps)), np.zeros((2, 2))
        for t in range(steps - 1, -1, -1):
            both = ahead[t] * back
            p[:, t] = both[:, 1] / both.sum(axis=1)
            if t:
                weighted = back.copy()
                weighted[:, 1] *= e[:, t]
                joint = ahead[t - 1][:, :, None] * psi * weighted[:, None, :]
                joint *= (filled[:, t] / joint.sum(axis=(1, 2)))[:, None, None]
                pairs += joint.sum(axis=0)
                new = weighted @ psi.T
                new /= new.sum(axis=1, keepdims=True)
                back = np.where(filled[:, t, None], new, back)
        return np.where(filled, p, 0.0), pairs

    def tag(self, features: np.ndarray, new: np.ndarray) -> np.ndarray:
        """P(toxic) per token of sequences laid end to end."""
        out = np.zeros(features.shape[1])
        if not len(out):
            return out
        emission = self.emissions(features)
        first = np.flatnonzero(new)
        lens = np.diff(np.concatenate([first, [len(new)]]))
        low = 0
        for width in (8, 16, 32, MAX_TOKENS):
            some = np.flatnonzero((lens > low) & (lens <= width))
            low = width
            for part in np.array_split(some, max(1, -(-len(some) * width // 500_000))):
                if len(part):
                    at = first[part][:, None] + np.arange(width)
                    filled = np.arange(width) < lens[part][:, None]
                    at = np.where(filled, at, 0)
                    p, _ = self.marginals(emission[at], filled)
                    out[at[filled]] = p[filled]
        return out

    def train(self, sentences: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Adaptive gradient steps on the log-likelihood; sentences are (features, labels)."""
        if not sentences:
            return
        seen, seen_move, seen_start = np.full(len(self.weights), 1e-8), np.full((2, 2), 1e-8), np.full(2, 1e-8)
        order = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for part in np.array_split(order.permutation(len(sentences)), -(-len(sentences) // BATCH)):
                chosen = [sentences[i] for i in part]
                steps = max(len(y) for _, y in chosen)
                filled = np.array([[t < len(y) for t in range(steps)] for _, y in chosen])
                kinds = chosen[0][0].shape[0]
                feats = np.zeros((kinds, len(chosen), steps), np.int64)
                labels = np.zeros((len(chosen), steps))
                for i, (f, y) in enumerate(chosen):
                    feats[:, i, : len(y)] = f
                    labels[i, : len(y)] = y
                p, pairs = self.marginals(self.emissions(feats), filled)
                diff = np.where(filled, labels - p, 0.0) / len(chosen)
                grad = np.zeros(len(self.weights))
                for k in range(kinds):
                    np.add.at(grad, feats[k][filled], diff[filled])
                lab = labels.astype(int)
                real = np.zeros((2, 2))
                np.add.at(real, (lab[:, :-1][filled[:, 1:]], lab[:, 1:][filled[:, 1:]]), 1)
                start = np.array([-diff[:, 0].sum(), diff[:, 0].sum()])
                move = (real - pairs) / len(chosen)
                for value, g, total in ((self.weights, grad - DECAY * self.weights, seen), (self.move, move, seen_move),
                                        (self.start, start, seen_start)):
                    total += g * g
                    value += RATE * g / np.sqrt(total)


def _tagged(raw: np.ndarray, offsets: np.ndarray, field: Field):
    low = TO_LOWER[raw]
    words = words_in(low, offsets, IS_LETTER)
    return words, field.tag(field.features(token_keys(low, words)), sentence_starts(low, words))


def evidence(words, p: np.ndarray) -> np.ndarray:
    """Per text: largest marginal, log of expected toxic tokens, their rate."""
    n = len(words.counts)
    owner = words.text_ids
    total = np.bincount(owner, p, n)
    most = np.zeros(n)
    np.maximum.at(most, owner, p)
    return np.stack([most, np.log1p(total), total / np.maximum(words.counts, 1)], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w), -5, 5)
    return w


def _sentences(known: np.ndarray):
    """Sentences of sampled documents, with token labels: all with a toxic token, of others one in sixteen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("label").to_numpy(zero_copy_only=False) == 1
            rows = batch.column("row").to_numpy().view(np.uint64)
            for a, _, raw, offs in text_slices(batch.column("text")):
                low = TO_LOWER[raw]
                words = words_in(low, offs, IS_LETTER)
                if not len(words.hashes):
                    continue
                keys = token_keys(low, words)
                lexical = _lexical(keys).view(np.int64)
                hit = np.isin(lexical, known).any(axis=0) & toxic[a + words.text_ids]
                first = np.flatnonzero(sentence_starts(low, words))
                lens = np.diff(np.concatenate([first, [len(hit)]]))
                owner = words.text_ids[first]
                # drawn by place, so that a common sentence is drawn as often as it stands
                place = mix(rows[a + owner] + (first - words.offsets[owner]).astype(np.uint64) * MULT)
                chosen = np.flatnonzero((np.add.reduceat(hit, first) > 0) | (place % np.uint64(16) == 0))
                at = np.concatenate([np.arange(first[c], first[c] + lens[c]) for c in chosen]) if len(chosen) else []
                at = np.asarray(at, np.int64)
                f = Field.features(keys)[:, at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(place[chosen] + MULT).view(np.int64)),
                     lists(f.T.ravel().astype(np.int32), lens[chosen] * f.shape[0], pa.int32()),
                     lists(hit[at].astype(np.int32), lens[chosen], pa.int32())], ["draw", "features", "labels"])
    return run


_EVIDENCE = "array<double>"


def _evidence(text: Column, field: Field) -> Column:
    @F.arrow_udf(_EVIDENCE)
    def udf(texts: pa.Array) -> pa.Array:
        parts = [evidence(*_tagged(raw, offs, field)) for _, _, raw, offs in text_slices(texts)]
        x = np.concatenate(parts) if parts else np.zeros((0, 3))
        return lists(x.ravel(), np.full(len(x), 3), pa.float64())

    return udf.asNondeterministic()(text)


class ToxicModel:
    def __init__(self, field: Field, logistic: np.ndarray):
        self.field, self.logistic = field, logistic


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column) -> ToxicModel | None:
    """Fit on labelled rows with ``learn`` true (an expression of doc_id); None without both kinds."""
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    ids = labelled_ids(labels, "toxic", learn)
    sample = stored(labelled_texts(texts, ids.where("label = 1"), TOXIC_DOCS, "toxic")
                    .unionByName(labelled_texts(texts, ids.where("label = 0"), CLEAN_DOCS, "clean")), "toxic-sample")
    kinds = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        return None
    known = lexicon(sample.where("label = 1"), sample.where("label = 0"))
    field = Field()
    cut = stored(sample.select("text", "label", F.xxhash64("doc_id", "text").alias("row")).mapInArrow(
        _sentences(known), "draw long, features array<int>, labels array<int>"), "toxic-sentences")
    share = 1.1 * SENTENCES / max(1, cut.count())
    cut = (cut.where(F.pmod("draw", F.lit(1 << 20)) < F.lit(int(min(1.0, share) * (1 << 20)))).orderBy("draw").limit(SENTENCES)
           .toPandas().sort_values("draw", kind="stable"))
    kinds_of = 2 + len(PREFIXES)
    field.train([(np.asarray(f, np.int64).reshape(-1, kinds_of).T, np.asarray(y, float))
                 for f, y in zip(cut["features"], cut["labels"])])
    rows = sample.select("doc_id", "label", _evidence(F.col("text"), field).alias("x")).toPandas()
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (rows["doc_id"].iloc[i], tuple(rows["x"].iloc[i])))]
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), 3)
    return ToxicModel(field, _fit_logistic(x, (rows["label"].to_numpy() == 1).astype(float)))


TAGGED_TYPE = "struct<score:double,spans:array<struct<start:bigint,stop:bigint>>>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def toxic_spans(text: Column, model: ToxicModel | None) -> Column:
    """Struct<score, spans> per text; spans are character offsets, stop exclusive."""
    if model is None:
        return F.struct(F.lit(0.0).alias("score"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))

    @F.arrow_udf(TAGGED_TYPE)
    def udf(texts: pa.Array) -> pa.Array:
        parts = []
        for _, _, raw, offs in text_slices(texts):
            words, p = _tagged(raw, offs, model.field)
            x = np.column_stack([evidence(words, p), np.ones(len(words.counts))])
            score = 1 / (1 + np.exp(-np.clip(x @ model.logistic, -30, 30)))
            hit = p >= SPAN
            owner = words.text_ids
            same = np.concatenate([[False], owner[1:] == owner[:-1]]) if len(hit) else hit
            first = np.flatnonzero(hit & ~(np.concatenate([[False], hit[:-1]]) & same))
            after = np.concatenate([hit[1:] & same[1:], [False]]) if len(hit) else hit
            last = np.flatnonzero(hit & ~after)
            chars = np.concatenate([[0], np.cumsum(_STARTS_CHAR[raw])])
            base = chars[offs[owner[first]]]
            spans = pa.StructArray.from_arrays([pa.array(chars[words.starts[first]] - base),
                                                pa.array(chars[words.ends[last]] - base)], fields=list(_SPAN))
            parts.append(pa.StructArray.from_arrays(
                [pa.array(score), lists(spans, np.bincount(owner[first], minlength=len(score)), _SPAN)], ["score", "spans"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("score", pa.float64()), ("spans", pa.list_(_SPAN))]))

    return udf.asNondeterministic()(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, score, spans for every row; learns from labels not held out."""
    model = fit_toxicity(docs, labels, ~held)
    out = docs.select("doc_id", held.alias("held_out"), toxic_spans(F.col("text"), model).alias("t"))
    return out.select("doc_id", "held_out", "t.score", "t.spans")
