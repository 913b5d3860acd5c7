"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (single tokens and pairs, in a fixed
number of buckets) are counted: one from the target text -- documents labelled
good -- and one from the raw text, which is all documents.  A document's log
importance weight is the log ratio of its probabilities under both, taken per
n-gram and scaled to ``LENGTH`` n-grams, so that long documents are not
favoured or punished for their length alone.  ``k`` documents are drawn
without replacement by the Gumbel top-k trick: the ``k`` largest values of log
weight plus Gumbel noise, the noise coming from a hash of seed, doc_id and text.
``k`` is the labelled share of good documents times the number of documents.

The target model is fitted on a bounded sample of labelled documents
(``TARGET_ROWS``); the raw model, the weights and the draw cover every row.

Edge cases: a text without tokens (null, empty, blank) has no evidence; its
weight is ``NO_TEXT`` and it is drawn last; rows with equal keys at the border
are all drawn; rows with equal doc_id and text share their noise; without
usable labels all weights are 0 and every row with tokens is drawn; an empty table gives an
empty result; other columns are ignored or, in :func:`resampled`, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import (IS_SPACE, MULT, labelled_sample, mix, run_hashes, stored, text_slices, unit_hash,
                                unused_name)

BUCKETS = 1 << 14
SMOOTH = 1.0
LENGTH = 100.0
TARGET_ROWS = 20_000
SEED = "quality-1"
NO_TEXT = -1.0e6
#: Keys are compared as integers of this many units, within +-2^40 of them.
UNITS = 1_000_000

_b = np.arange(256)
_WORDY = (_b >= 0x80) | ((_b >= 0x30) & (_b <= 0x39)) | ((_b >= 0x41) & (_b <= 0x5A)) | ((_b >= 0x61) & (_b <= 0x7A))
_CLASS = np.where(IS_SPACE, 0, np.where(_WORDY, 1, 2)).astype(np.int8)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of all n-grams; tokens are runs of word or of other signs."""
    kind = _CLASS[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    h = run_hashes(data, starts, ends)
    text = np.searchsorted(offsets, starts, side="right") - 1
    same = text[1:] == text[:-1]
    pairs = mix(h[:-1] * MULT + h[1:])[same]
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return (np.concatenate([h >> shift, pairs >> shift]).astype(np.int64), np.concatenate([text, text[1:][same]]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = np.asarray(batch.column("good").fill_null(False).to_numpy(zero_copy_only=False), bool)
        for a, _, data, offs in text_slices(batch.column("text")):
            bucket, text = grams(data, offs)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[a + text]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, good_ids: DataFrame) -> np.ndarray:
    """log p_target - log p_raw per bucket (``BUCKETS`` values)."""
    flagged = docs.select("doc_id", "text").join(
        F.broadcast(good_ids.select("doc_id", F.lit(True).alias("good"))), "doc_id", "left").select("text", "good")
    counted = (flagged.mapInArrow(_count, "bucket long, raw long, target long")
               .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.collect():  # at most BUCKETS rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    return (np.log((target + SMOOTH) / (target.sum() + SMOOTH * BUCKETS))
            - np.log((raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS)))


def log_weight(text: Column, ratios: np.ndarray) -> Column:
    """Log importance weight of a text column."""

    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        out = np.full(len(texts), NO_TEXT)
        for a, b, data, offs in text_slices(texts):
            bucket, at = grams(data, offs)
            n = np.bincount(at, minlength=b - a)
            total = np.bincount(at, weights=ratios[bucket], minlength=b - a)
            out[a:b] = np.where(n > 0, LENGTH * total / np.maximum(n, 1), NO_TEXT)
        return pa.array(out)

    return weigh.asNondeterministic()(text)  # a costly call: not to be repeated in pushed-down filters


def gumbel_key(weight: Column, *row: Column, seed: str = SEED) -> Column:
    """Log weight plus Gumbel noise from a hash of the row's parts, in whole units."""
    u = (unit_hash(seed, *row) + F.lit(2.0 ** -49))
    key = F.round((weight - F.log(-F.log(u))) * F.lit(float(UNITS)))
    return F.greatest(F.least(key, F.lit(float(1 << 40))), F.lit(-float(1 << 40))).cast("long")


def _text_hash() -> Column:
    return F.md5(F.col("text").cast("binary"))


def kth_largest(keys: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest integer of a column, |value| <= 2^40; None if there are fewer.

    Counts values in 2^14 intervals, then in those of the interval that holds
    the k-th, three times; only interval counts come to the driver.
    """
    if k <= 0:
        return None
    low, width = -(1 << 41), 1 << 28
    scope = keys
    while True:
        cell = F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("long")
        counts = dict(scope.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())
        for c in sorted(counts, reverse=True):
            if counts[c] >= k:
                break
            k -= counts[c]
        else:
            return None
        low = low + c * width
        if width == 1:
            return low
        scope = keys.where((F.col(column) >= low) & (F.col(column) < low + width))
        width = max(1, width >> 14)


def target_share(labels: DataFrame) -> float:
    """Share of good rows among those labelled; 1 without labels."""
    known = labels.where(F.col("quality").isNotNull())
    share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    return 1.0 if share is None else share


def _fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    good = labelled_sample(labels.where(F.col("quality") == 1), "quality", TARGET_ROWS)
    return log_ratios(docs, good)


def resample(docs: DataFrame, labels: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept for every row of ``docs``."""
    ratios = _fit(docs, labels)
    scored = stored(docs.select("doc_id", log_weight(F.col("text"), ratios).alias("log_weight"), _text_hash().alias("text_hash"))
                         .withColumn("gumbel_key", gumbel_key(F.col("log_weight"), F.col("doc_id"), F.col("text_hash"), seed=seed)),
                         "quality-weights").drop("text_hash")
    return scored.withColumn("kept", F.col("gumbel_key") >= F.lit(_border(scored, labels)))


def _border(scored: DataFrame, labels: DataFrame) -> int:
    """Smallest key that is drawn; rows without tokens are below it."""
    some = scored.where(F.col("log_weight") > NO_TEXT)
    k = round(target_share(labels) * some.count())
    border = kth_largest(some, "gumbel_key", k)
    return (1 << 42) if border is None else border


def resampled(docs: DataFrame, labels: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns."""
    ratios = _fit(docs, labels)
    weight, key = unused_name(docs, "log_weight"), unused_name(docs, "gumbel_key")
    scored = docs.withColumn(weight, log_weight(F.col("text"), ratios))
    scored = scored.withColumn(key, gumbel_key(F.col(weight), F.col("doc_id"), _text_hash(), seed=seed))
    slim = stored(scored.select(F.col(weight).alias("log_weight"), F.col(key).alias("gumbel_key")), "quality-keys")
    return scored.where(F.col(key) >= F.lit(_border(slim, labels))).select(*[F.col(f"`{c}`") for c in docs.columns])
