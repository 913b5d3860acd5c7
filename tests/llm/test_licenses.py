from helpers import docs_frame, lettered, odd_rows
from insight.llm import licenses
from insight.llm.licenses import BASE, TEMPLATES, scan_licenses


def plain(text):
    w = lettered(text)
    places, found = [], []
    for label, phrase in BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    for label, template, key in TEMPLATES:
        t, k = template.split(), key.split()
        at = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
        for i in range(len(w) - len(k) + 1):
            if w[i:i + len(k)] == k:
                same = sum(0 <= i - at + j < len(w) and w[i - at + j] == x for j, x in enumerate(t))
                found.append((label, same / len(t)))
    at = [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted({x for _, x in places} | {x for x, _ in found})), max((s for _, s in found), default=0.0))


TEXTS = [
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "mit license", "under the MIT", "cc by cc by nc by nc",
    "under the mit license under the mit license apache license version 2 cc by nc", "license " * 500 + "gnu general public license",
    "Mit der Version 2 the license version apache license", "redistribution and use in source and binary forms",
    " ".join("under the mit license" for _ in range(300)),
]


def test_scan_equals_the_plain_version(spark):
    rows = [(100 + i, t, "en", "a") for i, t in enumerate(TEXTS)] + odd_rows()
    got = sorted((tuple(r) for r in scan_licenses(docs_frame(spark, rows)).collect()), key=repr)
    want = sorted(((i, *plain(t)) for i, t, _, _ in rows), key=repr)
    assert got == want


def test_index_takes_the_rarest_words(spark):
    docs = docs_frame(spark, [(i, "under the license " * 3 + ("mit" if i == 0 else ""), "en", "a") for i in range(5)])
    from insight.llm.common import LETTER_GAP, lower_ascii, words_of
    from pyspark.sql import functions as F
    index = licenses.rare_index(docs.select(words_of(lower_ascii(F.col("text")), LETTER_GAP).alias("words")))
    assert [w for w, t, _ in index if t == 0 and w == "mit"] == ["mit"]
    assert max(sum(1 for _, t, _ in index if t == k) for k in range(len(TEMPLATES))) == licenses.RARE


def test_main_path_is_native(spark):
    df = scan_licenses(docs_frame(spark, odd_rows()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert scan_licenses(docs_frame(spark, [])).count() == 0
