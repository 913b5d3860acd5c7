import math
import random

import pytest

from helpers import docs_frame, labels_frame, odd_labels, odd_rows
from insight.llm import quality
from insight.llm.quality import kth_largest, resample, resampled


def corpus():
    rnd = random.Random(3)
    good = [f"g{i}" for i in range(60)]
    junk = [f"junk{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        words = rnd.choices(junk if bad else good, k=rnd.randint(20, 60))
        rows.append((i, " ".join(words) + ("!!" if bad else "."), "en", "a"))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def plain_weights(rows, labels):
    """The two models and the log weights, counted one n-gram at a time."""
    import numpy as np
    import pyarrow as pa
    from insight.llm.common import text_slices
    good = {i for i, q, _ in labels if i is not None and q == 1}
    grams = {}
    for k, (_, t, _, _) in enumerate(rows):
        grams[k] = []
        for _, _, raw, offs in text_slices(pa.array([t], pa.string())):
            grams[k] = quality.grams(raw, offs)[0].tolist()
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for k, (i, *_) in enumerate(rows):
        for g in grams[k]:
            raw[g] += 1
            target[g] += i in good
    b = quality.BUCKETS
    ratio = np.log((target + 1) / (target.sum() + b)) - np.log((raw + 1) / (raw.sum() + b)) if target.sum() else np.zeros(b)
    return [quality.LENGTH * sum(ratio[g] for g in grams[k]) / len(grams[k]) if grams[k] else quality.NO_TEXT for k in range(len(rows))]


@pytest.mark.parametrize("case", ["corpus", "odd", "no labels"])
def test_weights_and_draw_equal_the_plain_version(spark, case):
    rows, labels = corpus() if case == "corpus" else (odd_rows(), odd_labels() if case == "odd" else [])
    docs, marks = docs_frame(spark, rows), labels_frame(spark, labels)
    out = resample(docs, marks).collect()
    weights = plain_weights(rows, labels)
    assert sorted(round(r["log_weight"], 6) for r in out) == sorted(round(w, 6) for w in weights)
    some = [r for r in out if r["log_weight"] > quality.NO_TEXT]
    known = [q for _, q, _ in labels if q is not None]
    k = round(sum(q == 1 for q in known) / len(known) * len(some)) if known else len(some)
    border = sorted((r["gumbel_key"] for r in some), reverse=True)[k - 1]
    assert all(r["kept"] == (r["gumbel_key"] >= border) for r in out)
    kept = resampled(docs, marks)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r["doc_id"] for r in out if r["kept"]), key=repr)


def test_it_keeps_the_good_and_drops_the_rest(spark):
    rows, labels = corpus()
    out = {r["doc_id"]: r["kept"] for r in resample(docs_frame(spark, rows), labels_frame(spark, labels)).collect()}
    good = [out[i] for i in out if i % 5]
    bad = [out[i] for i in out if i % 5 == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_noise_is_gumbel(spark):
    df = spark.range(20000).select(quality.gumbel_key(quality.F.lit(0.0), quality.F.col("id")).alias("k"))
    mean, sd = df.agg(quality.F.avg("k"), quality.F.stddev("k")).first()
    assert abs(mean / 1e6 - 0.5772) < 0.03 and abs(sd / 1e6 - math.pi / math.sqrt(6)) < 0.03


def test_kth_largest_is_exact(spark):
    rnd = random.Random(5)
    values = [rnd.randint(-2**40, 2**40) for _ in range(500)] + [7] * 50 + [-(2**40), 2**40, 0, -1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 250, 275, len(values) - 1, len(values)):
        assert kth_largest(df, "v", k) == ranked[k - 1]
    assert kth_largest(df, "v", len(values) + 1) is None and kth_largest(df, "v", 0) is None


def test_empty_table(spark):
    docs, marks = docs_frame(spark, []), labels_frame(spark, [])
    assert resample(docs, marks).count() == 0 and resampled(docs, marks).count() == 0
