"""Text pipeline: train the post classifier on labelled documents, evaluate
it on the held-out rows, and score new posts and crawled pages (L3, ML1-ML8).

Order of steps as in the reference: the vocabulary is built from all
labelled documents before the split; the classifier is fit on the training
side only; new posts and pages are tokenised the same way, restricted to
the vocabulary and scored with the same model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.functions.text import STOP_WORDS, clean_text
from insight.operators import bayes as NB
from insight.operators.search import page_text
from insight.sources.checkpoint import materialize, tables_root
from insight.sources.tables import read_table


@dataclass
class TrainedModel:
    docs: DataFrame          # key, label (all labelled documents)
    tf: DataFrame            # key, label, alone, term, tf, is_test (all labelled documents)
    split: DataFrame         # key, label, is_test
    model: NB.NaiveBayesModel
    key: str = "doc_id"


def labelled_documents(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """Documents that carry a label: ``(doc_id, text, label)``."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
    return read_table(spark, sf_dir, "documents").join(labels, "doc_id").select("doc_id", "text", "label")


def train_model(docs: DataFrame, key: str = "doc_id", test_fraction: float = 0.25,
                stop_words: Sequence[str] = STOP_WORDS) -> TrainedModel:
    """Fit the classifier.

    The term table of the labelled documents feeds the vocabulary, the fit
    and the held-out scoring.  Each consumer gets different inferred filters
    pushed into its copy; the table is therefore written once to the checkpoint
    folder and scanned by every consumer.  It carries each document's label and
    side of the split, so that neither is joined to it.  The vocabulary, the
    split and the fitted tables, which scoring reads several times, are written too.
    """
    tf = materialize(NB.key_split(NB.term_frequencies(docs, key, "text", stop_words, keep=["label"]), key, test_fraction), "tf")
    vocab = materialize(NB.vocabulary_terms(tf), "vocab")        # ML1: all rows, before the split
    split = materialize(NB.key_split(docs.select(key, "label"), key, test_fraction), "split")
    fitted = NB.fit_naive_bayes(tf, split.filter(~F.col("is_test")), key, "label", vocab, split.count())
    fitted.classes, fitted.weights = materialize(fitted.classes, "classes"), materialize(fitted.weights, "weights")
    return TrainedModel(docs=split, tf=tf, split=split, model=fitted, key=key)


#: Fitted models of this process, by kind and state of the input files.
_FITTED: dict[tuple, TrainedModel] = {}


def _state(spark: SparkSession, sf_dir: str, tables: Sequence[str]) -> tuple:
    """What identifies the tables' content: a hash of their files' paths, sizes and modification times."""
    out = []
    for t in tables:
        files = read_table(spark, sf_dir, t).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        out.append(tuple(files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*files.columns))).first()))
    return tuple(out)


def _fitted_once(spark: SparkSession, sf_dir: str, kind: str, tables: Sequence[str], docs) -> TrainedModel:
    """The model of ``docs()``, fitted once per application for the same input files, as the reference fits once and scores three inputs."""
    key = (tables_root(spark), kind, sf_dir, _state(spark, sf_dir, tables))
    if key not in _FITTED:
        _FITTED[key] = train_model(docs())
    return _FITTED[key]


def quality_model(spark: SparkSession, sf_dir: str) -> TrainedModel:
    """The classifier of ``labels.quality`` on ``documents``."""
    return _fitted_once(spark, sf_dir, "quality", ("documents", "labels"), lambda: labelled_documents(spark, sf_dir, "quality"))


def language_model(spark: SparkSession, sf_dir: str) -> TrainedModel:
    """A four-class classifier: ``documents.lang`` as the label."""
    return _fitted_once(spark, sf_dir, "lang", ("documents",), lambda: read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("lang").alias("label")))


def quality_test_predictions(tm: TrainedModel) -> DataFrame:
    """ML3: ``(doc_id, truth, predicted, score)`` on the held-out rows."""
    k = tm.key
    test = tm.split.filter(F.col("is_test")).select(k, F.col("label").alias("truth"))
    # the vocabulary was made from these documents too
    pred = NB.predict_naive_bayes(tm.model, tm.tf.filter("is_test"), test, k, restrict_to_vocab=False)
    return test.join(pred, k).select(k, "truth", "predicted", "score")


def quality_confusion(tm: TrainedModel) -> DataFrame:
    """ML6: confusion counts, labels in order of first appearance."""
    levels = NB.label_levels(tm.docs, tm.key)
    return NB.confusion_matrix(quality_test_predictions(tm), levels)


def quality_metrics(tm: TrainedModel) -> DataFrame:
    """ML7/ML8: per-label precision, recall and F1."""
    return NB.classification_metrics(quality_confusion(tm))


def _score(tm: TrainedModel, rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Cleaned text and predicted class of every row; each text is tokenised once."""
    cleaned = materialize(rows.select(*[c for c in rows.columns if c != text], clean_text(F.col(text)).alias("text_clean")),
                          "cleaned")
    # the cleaned text holds the tokens that are left after the stop words
    tf = materialize(NB.term_frequencies(cleaned, keys, "text_clean", ()), "tf")
    return cleaned.join(NB.predict_naive_bayes(tm.model, tf, cleaned, keys), keys)


def score_posts(tm: TrainedModel, posts: DataFrame, key: str | Sequence[str],
                text: str = "text") -> DataFrame:
    """ML4: cleaned text and predicted class of every post."""
    keys = [key] if isinstance(key, str) else list(key)
    return _score(tm, posts.select(*keys, text), keys, text).select(*keys, "text_clean", "predicted", "score")


def score_pages(tm: TrainedModel, pages: DataFrame) -> DataFrame:
    """ML5: body text of every stored page, cleaned and classified."""
    return _score(tm, page_text(pages), ["page_id"], "content").select("page_id", "url", "text_clean", "predicted", "score")


# --------------------------------------------------------------------------
# L2: crawl results handed on as text files, one record per line

def export_post_search(posts: DataFrame, terms: Sequence[str], path: str, key: str = "post_id",
                       max_results: int | None = None) -> None:
    """Posts matching every term (re-posts left out, newlines flattened),
    written one per line in key order."""
    from insight.operators.search import search_posts
    from insight.sources.textfile import write_lines
    found = search_posts(posts, terms, key=key, max_results=max_results)
    write_lines(found.orderBy(key), path)


def export_page_text(pages: DataFrame, path: str) -> None:
    """Visible text of every stored page, newlines and tabs flattened,
    written one page per line."""
    from insight.functions.text import flatten_whitespace
    from insight.sources.textfile import write_lines
    content = page_text(pages).select("page_id", flatten_whitespace("content", "\n\t").alias("text"))
    write_lines(content.orderBy("page_id"), path)
