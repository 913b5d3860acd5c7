"""Bag of words and multinomial Naive Bayes over DataFrames (ML1-ML8, JN2, JN4, WN5).

Model (Laplace ``alpha``, class priors = class frequencies, as the
reference's classifier defaults)::

    log_prior(c)    = log(n_c / N)
    log_prob(c, t)  = log((count(c, t) + alpha) / (total(c) + alpha * V))

``V`` is the vocabulary size, ``count`` the summed term frequency of term
``t`` in training documents of class ``c`` and ``total(c)`` its sum over
terms.  A document's score is ``log_prior(c) + sum_t tf(t) * log_prob(c, t)``
over its terms in the vocabulary; the prediction is the best class, the
lowest class on a tie.

Sparse evaluation.  ``log_prob`` of a term never seen with class ``c`` is
the per-class constant ``log_unseen(c) = log(alpha / (total(c) + alpha V))``.
Hence::

    score(d, c) = log_prior(c) + L(d) * log_unseen(c)
                  + sum over t in d with count(c, t) > 0 of tf(t) * log(1 + count(c, t) / alpha)

with ``L(d)`` the number of known tokens of ``d``.  The model therefore
only stores observed (class, term) pairs -- never the V x K dense table --
and scoring is one equi-join on ``term`` plus the K class rows.

Frequent terms.  A term that stands in a large share of the documents would be
a hot join key.  Document frequencies are known from the vocabulary, so terms
of at least ``HOT_SHARE`` of the documents are joined by broadcast (there are
at most ``average distinct terms per document / HOT_SHARE`` of them, whatever
the number of documents), and the others, none of which holds more than that
share, by a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.functions.text import STOP_WORDS
from insight.operators.aggregate import with_scalar
from insight.operators.contingency import confusion
from insight.operators.joins import nsjoin
from insight.sources.checkpoint import materialize

#: Share of the vocabulary's documents from which a term is joined by broadcast.
HOT_SHARE = 0.01


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# --------------------------------------------------------------------------
# bag of words (SC12, AG14, ML1)

#: Distinct terms that a task collects from its rows before it passes them on.
PASSED_TERMS = 1 << 17


def _row_terms(stop_words: Sequence[str], min_len: int):
    """For mapInArrow: rows ``(..., text)`` to ``(..., term, tf)``, each row's terms counted by themselves."""
    stop, word = frozenset(stop_words), re.compile("[A-Za-z]+")

    def rows(batch, at, terms, counts):
        # one entry of ``at`` per row: its place and its number of distinct terms
        places = np.repeat(np.array([i for i, _ in at], np.int64), [n for _, n in at])
        kept = [batch.column(j).take(pa.array(places)) for j in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays([*kept, pa.array(terms, pa.string()), pa.array(counts, pa.int64())],
                                          [*batch.schema.names[:-1], "term", "tf"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, terms, counts = [], [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                bag = Counter(w.lower() for w in word.findall(text.as_py() or "") if len(w) >= min_len and w not in stop)
                at.append((i, len(bag)))
                terms.extend(bag.keys())
                counts.extend(bag.values())
                if len(terms) > PASSED_TERMS:
                    yield rows(batch, at, terms, counts)
                    at, terms, counts = [], [], []
            if terms:
                yield rows(batch, at, terms, counts)
    return run


def term_frequencies(docs: DataFrame, key: str | Sequence[str], text: str = "text",
                     stop_words: Sequence[str] = STOP_WORDS, min_len: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """AG14: ``(key..., term, tf)`` -- the sparse document-term matrix, long form.

    Same tokens as :func:`insight.functions.text.bag_of_words_terms`: letter
    runs without the stop words (case-sensitive, before lower-casing),
    lower-cased, of ``min_len`` or more characters.  A row's terms are counted
    where the row is: a task holds the terms of a few rows, and nothing is
    shuffled.  Only rows whose key stands on several rows, which are one
    document, are summed by (document, term).

    With ``keep``, columns of the row go along, and ``alone`` tells whether the
    key stands on one row; if it does not, the kept columns are null.
    """
    keys = _keys(key)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys, *keep).schema.fields)

    def counted(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, *keep, text).mapInArrow(_row_terms(stop_words, min_len), f"{fields}, term string, tf bigint")

    several = materialize(docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys), "several-rows")
    alone = several.isEmpty()
    out = counted(docs if alone else nsjoin(docs, several, keys, "left_anti"))
    if keep:
        out = out.withColumn("alone", F.lit(True))
    if alone:
        return out
    summed = counted(nsjoin(docs, several, keys, "left_semi")).groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))
    if keep:
        summed = summed.withColumn("alone", F.lit(False))
    return out.unionByName(summed, allowMissingColumns=True)


def vocabulary_terms(tf: DataFrame) -> DataFrame:
    """The vocabulary as ``(term, doc_freq)`` -- what fitting and scoring need."""
    # tf has one row per (document, term): the row count is the document frequency
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))


def vocabulary(tf: DataFrame, key: str | Sequence[str] | None = None) -> DataFrame:
    """Vocabulary ``(term, doc_freq, term_index)``; ``term_index`` is the
    0-based position in alphabetical order (the reference's feature index).

    The position comes from :func:`insight.operators.ranking.row_positions`:
    range partitions on the term, row counts per partition turned into offsets,
    numbering within each partition -- no single-task sort of the vocabulary.
    """
    from insight.operators.ranking import row_positions
    return (row_positions(vocabulary_terms(tf), "term", "__pos")
            .select("term", "doc_freq", (F.col("__pos") - 1).alias("term_index")))


# --------------------------------------------------------------------------
# split (ST2)

GOLDEN = 2654435761
SPACE = 1 << 32
KEY_SPACE = 1 << 31


def key_split(df: DataFrame, key: str, test_fraction: float = 0.25, salt: int = 0) -> DataFrame:
    """ST2: deterministic hash split; adds boolean ``is_test``.

    Multiplicative hashing of the integer key spreads neighbouring ids over
    the unit interval; the test set is the fraction below ``test_fraction``.
    Every row lands in exactly one side.  Any 64-bit key will do: it is reduced
    modulo 2^31 first, so that the product fits a signed 64-bit integer.
    """
    threshold = int(test_fraction * SPACE)
    h = F.pmod(F.pmod(F.col(key), F.lit(KEY_SPACE)) * F.lit(GOLDEN) + F.lit(salt), F.lit(SPACE))
    return df.withColumn("is_test", h < threshold)


def exact_split(df: DataFrame, key: str, by: str | Sequence[str] = (), test_fraction: float = 0.25, salt: int = 0) -> DataFrame:
    """ST2, exact form: ``df`` with boolean ``is_test``; each stratum ``by`` has ``ceil(n * test_fraction)`` test rows.

    The test rows of a stratum are those of the smallest key hashes (the hash of
    :func:`key_split`), ties broken by the key.  The border is found by interval counts:
    2^16 intervals of the hash, then those of the interval that holds it, then the rows
    of that one hash, which are numbered over range partitions.  No stratum is sorted or
    gathered; only counts per interval move.
    """
    from insight.operators.ranking import row_positions
    strata = list(_keys(by)) or ["__all"]
    src = df if _keys(by) else df.withColumn("__all", F.lit(0))
    h = F.pmod(F.pmod(F.col(key), F.lit(KEY_SPACE)) * F.lit(GOLDEN) + F.lit(salt), F.lit(SPACE))
    hashed = src.withColumn("__h", h)
    counted = materialize(hashed.groupBy(*strata, "__h").agg(F.count(F.lit(1)).alias("__n")), "split-counts")
    border = counted.groupBy(*strata).agg(F.ceil(F.sum("__n") * F.lit(test_fraction)).cast("bigint").alias("__k")).withColumn("__at", F.lit(0).cast("bigint"))
    for shift in (16, 0):
        # the interval that holds the k-th hash; k counts on from its start
        cell = F.shiftright("__h", shift)
        cells = nsjoin(counted, border, strata).where(F.shiftright("__h", shift + 16) == F.col("__at")).groupBy(*strata, "__k", cell.alias("__cell")).agg(
            F.sum("__n").alias("__n"))
        upto = F.sum("__n").over(Window.partitionBy(*strata).orderBy("__cell"))
        cells = cells.withColumn("__before", upto - F.col("__n"))
        border = materialize(cells.where((F.col("__before") < F.col("__k")) & (F.col("__k") <= F.col("__before") + F.col("__n")))
                             .select(*strata, (F.col("__k") - F.col("__before")).alias("__k"), F.col("__cell").alias("__at")), "split-border")
    marked = nsjoin(hashed, border, strata, "left")
    sure = marked.where("__h <> __at").withColumn("is_test", F.col("__h") < F.col("__at"))
    tied = row_positions(marked.where("__h = __at").withColumn("__order", F.struct(*strata, key)), "__order", "__pos")
    tied = materialize(tied, "split-ties")
    first = tied.groupBy(*strata).agg(F.min("__pos").alias("__first"))
    tied = nsjoin(tied, first, strata).withColumn("is_test", F.col("__pos") - F.col("__first") < F.col("__k"))
    out = [*[F.col(f"`{c}`") for c in df.columns], F.col("is_test")]
    return sure.select(*out).unionByName(tied.select(*out))


def random_split(df: DataFrame, test_fraction: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """ST2, sampling form: ``(train, test)`` with a seeded ``randomSplit``."""
    train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed)
    return train, test


# --------------------------------------------------------------------------
# fit (ML2)

@dataclass
class NaiveBayesModel:
    classes: DataFrame      # label, n_docs, total_count, log_prior, log_unseen
    weights: DataFrame      # label, term, count, log_prob, weight
    vocab: DataFrame        # term, doc_freq
    n_vocab_docs: int       # documents the vocabulary was made from
    label: str = "label"


def fit_naive_bayes(tf: DataFrame, labels: DataFrame, key: str | Sequence[str],
                    label: str = "label", vocab: DataFrame | None = None,
                    n_vocab_docs: int | None = None, alpha: float = 1.0) -> NaiveBayesModel:
    """ML2: fit on the training documents ``labels (key..., label)``.

    ``tf`` may hold more documents than ``labels`` (e.g. the test rows):
    the vocabulary -- and so ``V`` -- comes from ``vocab`` if given, else from
    every document in ``tf``, which is the reference's order (vectoriser fit
    on all rows before the split).  ``n_vocab_docs`` is the number of those
    documents, counted if it is not given.

    If ``tf`` carries ``label``, ``alone`` (see :func:`term_frequencies`) and
    ``is_test``, and ``labels`` are the documents that are not ``is_test``, only
    the terms of documents of several rows are joined to their labels.
    """
    keys = _keys(key)
    vocab = vocab if vocab is not None else vocabulary_terms(tf)
    if n_vocab_docs is None:
        n_vocab_docs = tf.select(*keys).distinct().count()
    v_size = vocab.agg(F.count(F.lit(1)).cast("double").alias("__v"))
    train = labels.select(*keys, F.col(label).alias("label"))
    counts = train.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    own = {"label", "alone", "is_test"} <= set(tf.columns)
    joined = (tf.where("NOT alone AND NOT is_test").drop("label") if own else tf).join(train, keys).select("label", "term", "tf")
    if own:
        joined = tf.where("alone AND NOT is_test").select("label", "term", "tf").unionByName(joined)
    # read for the totals and for the weights
    feat = materialize(joined.groupBy("label", "term").agg(F.sum("tf").alias("count")), "term-counts")
    totals = feat.groupBy("label").agg(F.sum("count").alias("total_count"))
    n_all = counts.agg(F.sum("n_docs").cast("double").alias("__n"))
    classes = (with_scalar(with_scalar(counts.join(totals, "label", "left"), n_all), v_size)
               .withColumn("total_count", F.coalesce("total_count", F.lit(0)).cast("long"))
               .select("label", "n_docs", "total_count",
                       F.log(F.col("n_docs") / F.col("__n")).alias("log_prior"),
                       F.log(F.lit(alpha) / (F.col("total_count") + F.lit(alpha) * F.col("__v")))
                       .alias("log_unseen")))
    # one row per class: the terms of a class stay in many tasks
    weights = (feat.join(F.broadcast(classes.select("label", "log_unseen")), "label")
               .withColumn("weight", F.log((F.col("count") + alpha) / F.lit(alpha)))
               .select("label", "term", "count",
                       (F.col("weight") + F.col("log_unseen")).alias("log_prob"), "weight"))
    return NaiveBayesModel(classes=classes, weights=weights, vocab=vocab, n_vocab_docs=n_vocab_docs,
                           label=label)


# --------------------------------------------------------------------------
# predict (JN2, JN4, ML3, WN5)

def predict_naive_bayes(model: NaiveBayesModel, tf: DataFrame, docs: DataFrame,
                        key: str | Sequence[str], restrict_to_vocab: bool = True) -> DataFrame:
    """ML3: ``(key..., predicted, score)`` for every row of ``docs``.

    ``tf`` holds the documents' term frequencies (read twice: pass a stored
    table); terms outside the model vocabulary are dropped, as the fitted
    vectoriser ignores unseen words.  Documents without a known term get the
    prior-only prediction.  ``restrict_to_vocab`` may be false if all terms are
    known, as those of documents that the vocabulary was made from.
    """
    keys = _keys(key)
    hot = F.col("doc_freq") >= F.lit(HOT_SHARE * model.n_vocab_docs)
    hot_terms = F.broadcast(model.vocab.filter(hot).select("term"))
    rows = tf.select(*keys, "term", "tf")
    often, seldom = rows.join(hot_terms, "term", "left_semi"), rows.join(hot_terms, "term", "left_anti")
    weights = model.weights.select("term", "label", "weight")
    if restrict_to_vocab:
        # a known term also counts once without a class, for the length
        weights = weights.unionByName(model.vocab.select("term", F.lit(1.0).alias("weight")), allowMissingColumns=True)
    hot_weights = F.broadcast(weights.join(hot_terms, "term", "left_semi"))
    cold_weights = weights.join(hot_terms, "term", "left_anti")
    gain = F.col("tf") * F.col("weight")
    parts = (often.join(hot_weights, "term").select(*keys, "label", gain.alias("s"))
             .unionByName(seldom.join(cold_weights, "term").select(*keys, "label", gain.alias("s"))))
    gains = parts.groupBy(*keys, "label").agg(F.sum("s").alias("gain"))
    if restrict_to_vocab:
        gains = materialize(gains, "gains")
        lengths = gains.where("label IS NULL").select(*keys, F.col("gain").alias("len"))
        gains = gains.where("label IS NOT NULL")
    else:
        lengths = rows.groupBy(*keys).agg(F.sum("tf").alias("len"))
    # K rows, one per class: every document meets every class
    classes = model.classes.agg(F.collect_list(F.struct("label", "log_prior", "log_unseen")).alias("__classes"))
    every = (with_scalar(docs.select(*keys).join(lengths, keys, "left"), classes)
             .select(*keys, F.coalesce("len", F.lit(0)).alias("len"), F.explode("__classes").alias("c"))
             .select(*keys, "len", "c.*"))
    scores = (every.join(gains, [*keys, "label"], "left")
              .withColumn("score", F.coalesce("gain", F.lit(0.0)) + F.col("len") * F.col("log_unseen")
                          + F.col("log_prior")))
    best = F.min_by(F.col("label"), F.struct(-F.col("score"), F.col("label")))
    return scores.groupBy(*keys).agg(best.alias("predicted"), F.max("score").alias("score"))


# --------------------------------------------------------------------------
# evaluation (ML6, ML7, ML8)

def label_levels(labels: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Labels in order of first appearance: ``(label, level)``, 1-based.

    The window runs over one row per label.
    """
    firsts = labels.groupBy(F.col(label).alias("label")).agg(F.min(key).alias("__first"))
    level = F.dense_rank().over(Window.orderBy("__first", "label"))
    return firsts.select("label", level.cast("int").alias("level"))


def confusion_matrix(pred: DataFrame, levels: DataFrame, truth: str = "truth",
                     predicted: str = "predicted") -> DataFrame:
    """ML6: confusion counts in label order, zero cells included."""
    return confusion(pred, truth, predicted, levels)


def classification_metrics(conf: DataFrame, truth: str = "truth",
                           predicted: str = "predicted") -> DataFrame:
    """ML7/ML8: per label ``tp, n_true, n_pred, precision, recall, f1``;
    an undefined ratio is 0.  The binary F1 is the row of the positive label.

    One pass over the confusion table: each cell contributes to the true
    count of its truth label, the predicted count of its predicted label and,
    on the diagonal, the true positives.
    """
    n = F.col("n")
    contrib = F.array(
        F.struct(F.col(truth).alias("label"), F.col("truth_level").alias("level"),
                 F.when(F.col(truth) == F.col(predicted), n).otherwise(F.lit(0)).alias("tp"),
                 n.alias("n_true"), F.lit(0).cast("long").alias("n_pred")),
        F.struct(F.col(predicted).alias("label"), F.col("predicted_level").alias("level"),
                 F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("n_true"),
                 n.alias("n_pred")))
    m = (conf.select(F.inline(contrib))
         .groupBy("label", "level")
         .agg(F.sum("tp").alias("tp"), F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred")))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_true").cast("double")), F.lit(0.0))
    m = m.withColumn("precision", p).withColumn("recall", r)
    f1 = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return m.withColumn("f1", f1)


def binary_f1(metrics: DataFrame, positive=1) -> DataFrame:
    """ML8 binary form: one row, the F1 of the positive label."""
    return metrics.filter(F.col("label") == F.lit(positive)).select(F.col("f1").alias("f1_binary"))
