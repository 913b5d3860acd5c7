"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams (1 to ``GRAM`` characters of
the lower-cased text, everything but letters read as one blank), hashed to
``DIM`` dimensions: (1 + log count) * idf, scaled to unit length.  Document
frequencies are counted over all training documents.  Weights are trained by
follow-the-regularised-leader with elastic-net penalties on a bounded sample
(``PER_LANG`` documents a language at most), and a temperature, set on a part of
that sample that the weights have not seen, calibrates the probabilities.

Training documents are those with a text, a lang and ``learn`` true.  The sample is
drawn by doc_id and text: equal rows count once in it, and an id that holds many texts
is drawn text by text.  lang is a code from a small set, which comes to the driver; over
``LANGS`` of them are refused.

Edge cases: a text that is null or has no letter gets ``und`` with score 0, and
so does every text if there is nothing to learn from; with one language it is always
predicted; ties go to the smaller code; rows are predicted one by one; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.common import lists, mix, text_draw

GRAM = 3
DIM = 1 << 14
PER_LANG = 1500
#: Languages that can be learned: each is a column of the weights, on the driver and in every task.
LANGS = 1000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.001
CHUNK_DOCS, CHUNK_CHARS = 256, 1_000_000
NONE = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of distinct n-grams, and letters per text."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = _is_letter()[code]
    letters = np.bincount(owner[letter], minlength=len(low))
    keep = letter.copy()  # one blank after each run of letters
    keep[1:] |= letter[:-1]
    line, owner = np.where(letter, code, np.uint32(32))[keep].astype(np.uint64), owner[keep]
    cells = np.zeros(len(low) * DIM, np.int64)
    shift = np.uint64(64 - DIM.bit_length() + 1)
    for n in range(1, GRAM + 1):
        m = len(line) - n + 1
        if m <= 0:
            break
        key = np.full(m, n, np.uint64)
        for j in range(n):
            key = key * np.uint64(0x110003) + line[j: j + m]
        ok = owner[:m] == owner[n - 1:]
        if n == 1:
            ok &= line != 32
        cells += np.bincount((owner[:m] * DIM + (mix(key) >> shift).astype(np.int64))[ok], minlength=len(cells))
    at = np.flatnonzero(cells)
    return at // DIM, at % DIM, cells[at], letters


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and b - a < CHUNK_DOCS and (b == a or size + len(texts[b] or "") <= CHUNK_CHARS):
            size += len(texts[b] or "")
            b += 1
        yield a, b
        a = b


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(DIM, np.int64)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in _chunks(texts):
            df += np.bincount(gram_counts(texts[a:b])[1], minlength=DIM)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["bucket", "n"])


def _gram_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in _chunks(texts):
            owner, bucket, count, _ = gram_counts(texts[a:b])
            many = np.bincount(owner, minlength=b - a)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(a, b - a), batch.column("draw").slice(a, b - a),
                 lists(bucket.astype(np.int32), many, pa.int32()), lists(count.astype(np.int32), many, pa.int32())],
                ["lang", "draw", "bucket", "count"])


class LangModel:
    """Codes, idf, weights (DIM x codes), bias and temperature."""

    def __init__(self, codes, idf, weights, bias, temperature):
        self.codes, self.idf, self.weights, self.bias, self.temperature = codes, idf, weights, bias, temperature

    def logits(self, owner, bucket, count, n: int) -> np.ndarray:
        value = (1 + np.log(count)) * self.idf[bucket]
        size = np.sqrt(np.bincount(owner, value * value, n))
        value = value / np.maximum(size, 1e-12)[owner]
        return self.bias + np.stack([np.bincount(owner, value * self.weights[bucket, k], n)
                                     for k in range(len(self.codes))], axis=1)

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Best code and its probability per text."""
        owner, bucket, count, letters = gram_counts(texts)
        p = _softmax(self.logits(owner, bucket, count, len(texts)) / self.temperature)
        best = p.argmax(axis=1)
        return (np.where(letters > 0, np.array(self.codes, dtype=object)[best], NONE),
                np.where(letters > 0, p[np.arange(len(p)), best], 0.0))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from (bucket, value, class) rows, one update per row."""
    z, n = np.zeros((DIM, k)), np.zeros((DIM, k))
    bias, seen = np.zeros(k), np.zeros(k)

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, value, y in rows:
            w = weights(z[at], n[at])
            g = _softmax(bias + value @ w)
            g[y] -= 1
            step = value[:, None] * g
            more = n[at] + step * step
            z[at] += step - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
            seen += g * g
            bias -= ALPHA / (BETA + np.sqrt(seen)) * g * 0.1
    return weights(z, n), bias


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(u: float) -> float:
        p = _softmax(logits / np.exp(u))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    a, b, r = np.log(0.01), np.log(10.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit_languages(docs: DataFrame, learn: Column) -> LangModel | None:
    """Fit on the rows with a text, a lang and ``learn`` true; None without any."""
    rows = (docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull())
            .select("doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("key")))
    # equal rows count once in the sample; the document frequencies are those of all rows
    found = (rows.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("lang")
             .agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n")).limit(LANGS + 1).collect())
    if len(found) > LANGS:
        raise ValueError(f"more than {LANGS} languages: each has a weight column on the driver and in every task")
    sizes = {r["lang"]: r["texts"] for r in found}
    if not sizes:
        return None
    codes = sorted(sizes)
    total = sum(r["n"] for r in found)
    df = np.zeros(DIM)
    counted = rows.select("text").mapInArrow(_document_frequency, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # at most DIM rows
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1
    rates = F.create_map(*[x for c in codes for x in (F.lit(c), F.lit(min(1.0, PER_LANG / sizes[c])))])
    drawn = rows.withColumn("draw", text_draw("lang", F.col("key")) / F.element_at(rates, F.col("lang"))).where("draw < 1")
    drawn = drawn.dropDuplicates(["lang", "key"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))  # about PER_LANG rows each
    sample = (drawn.withColumn("place", place).where(F.col("place") <= PER_LANG)
              .select("text", "lang", "draw").mapInArrow(_gram_lists, "lang string, draw double, bucket array<int>, count array<int>")
              .toPandas().sort_values(["draw", "lang"], kind="stable"))
    train, check = [], []
    for lang, part, bucket, count in zip(sample["lang"], sample["draw"], sample["bucket"], sample["count"]):
        if not len(bucket):
            continue
        value = (1 + np.log(count)) * idf[bucket]
        row = (np.asarray(bucket), value / np.sqrt((value * value).sum()), codes.index(lang))
        (check if part >= 0.8 else train).append(row)
    weights, bias = train_ftrl(train, len(codes))
    logits = np.array([bias + value @ weights[at] for at, value, _ in check]).reshape(-1, len(codes))
    return LangModel(codes, idf, weights, bias, temperature(logits, np.array([y for _, _, y in check], dtype=int)))


def language(text: Column, model: LangModel | None) -> Column:
    """Struct<lang, score> per text."""
    kind = "struct<lang:string,score:double>"
    if model is None:
        return F.struct(F.lit(NONE).alias("lang"), F.lit(0.0).alias("score"))

    @F.arrow_udf(kind)
    def udf(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        parts = [model.predict(texts[a:b]) for a, b in _chunks(texts)]
        langs = np.concatenate([p[0] for p in parts]) if parts else []
        scores = np.concatenate([p[1] for p in parts]) if parts else []
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return udf.asNondeterministic()(text)


def identify(docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns from the rows not held out."""
    model = fit_languages(docs, ~held)
    out = docs.select("doc_id", held.alias("held_out"), language(F.col("text"), model).alias("l"))
    return out.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"))
