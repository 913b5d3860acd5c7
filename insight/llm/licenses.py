"""Licence scan by a positional index of rare tokens (DataFrame functions only).

Each licence has a template: a run of words, part of which is its mandatory key
phrase.  Document frequencies of the template words over all documents give
their IDF; the ``RARE`` rarest words of each key phrase are posted as (word,
template, position).  A file's words that occur in this index are looked up,
postings and file positions are intersected by relative position (file
position minus template position), an alignment on which all posted words of
the template agree is a candidate, and the key phrase is verified there word by
word.  As posted words are part of the key phrase, no verified place can be
missed.

``score`` is the largest share of a template's words that stand at their place
around a verified key phrase; 0 without one.

Edge cases: null and empty texts have no words, no places, empty label strings
and score 0; places may overlap; repeated rows are scanned alike; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.common import LETTER_GAP, lower_ascii, words_of

#: Label, template words, key phrase (a run of the template).
TEMPLATES = (
    ("mit", "released under the mit license", "under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     "permission to use copy modify and or distribute this software"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge to any person obtaining a copy"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software released into the public domain"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
)
#: Base phrases; their places are counted one by one.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
RARE = 2


def _run(words: list[str], inner: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i: i + len(inner)] == inner)


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rare_index(worded: DataFrame, templates=TEMPLATES, rare: int = RARE) -> list[tuple[str, int, int]]:
    """(word, template number, template position) of each key phrase's rarest words.

    ``worded`` has the column ``words``.  The result has at most ``rare`` rows
    per template; the frequencies read are those of the templates' words.
    """
    vocab = sorted({w for _, _, key in templates for w in key.split()})
    found = worded.select(F.explode(F.array_intersect("words", _strings(vocab))).alias("word"))
    df = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for t, (_, text, key) in enumerate(templates):
        words, inner = text.split(), key.split()
        at = _run(words, inner)
        best = sorted(set(inner), key=lambda w: (df.get(w, 0), w))[:rare]
        out += [(w, t, at + inner.index(w)) for w in sorted(best)]
    return out


def _phrase_at(words: Column, phrase: list[str], i: Column) -> Column:
    ok = None
    for k, w in enumerate(phrase):
        c = F.get(words, i + F.lit(k)) == F.lit(w)
        ok = c if ok is None else ok & c
    return F.coalesce(ok, F.lit(False))


def _places(words: Column, label: str, run: list[str]) -> Column:
    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: _phrase_at(words, run, i))
    rows = F.transform(starts, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))
    return F.coalesce(F.when(F.array_contains(words, max(run, key=len)), rows),
                      F.array().cast("array<struct<at:bigint,label:string>>"))


def base_places(words: Column, phrases=BASE) -> Column:
    """array<struct<at,label>> of the places where a phrase's words stand consecutively."""
    return F.concat(*[_places(words, label, phrase.split()) for label, phrase in phrases])


def _verified(words: Column, hits: Column, t: int, template: tuple[str, str, str], need: int) -> Column:
    """Alignments of template ``t`` that hold all ``need`` posted words and the key phrase."""
    label, text, key = template
    run, inner = text.split(), key.split()
    at = _run(run, inner)
    # sorted, an alignment with all posted words is `need` equal offsets in a row
    offs = F.array_sort(F.transform(F.filter(hits, lambda h: h["t"] == t), lambda h: h["off"]))
    full = F.filter(offs, lambda o, i: F.coalesce(F.get(offs, i + F.lit(need - 1)) == o, F.lit(False)))
    keyed = F.filter(full, lambda o: _phrase_at(words, inner, o + F.lit(at)))

    def share(o):
        n = F.lit(0)
        for k, w in enumerate(run):
            n = n + F.when(F.get(words, o + F.lit(k)) == F.lit(w), 1).otherwise(0)
        return n.cast("double") / F.lit(float(len(run)))

    return F.transform(keyed, lambda o: F.struct(F.lit(label).alias("label"), share(o).alias("score")))


def aligned(words: Column, index: list[tuple[str, int, int]], templates=TEMPLATES) -> Column:
    """array<struct<label,score>> of verified alignments."""
    kind = "array<struct<label:string,score:double>>"
    posted = sorted({w for w, _, _ in index})
    by_word = F.array(*[F.struct(F.lit(w).alias("w"), F.array(
        *[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for x, t, p in index if x == w]).alias("at")) for w in posted])
    spots = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                     lambda x: F.array_contains(_strings(posted), x["w"]))
    # postings of each spot, as (template, file position - template position)
    hits = F.flatten(F.transform(spots, lambda x: F.flatten(F.transform(
        F.filter(by_word, lambda b: b["w"] == x["w"]),
        lambda b: F.transform(b["at"], lambda q: F.struct(q["t"].alias("t"), (x["i"] - q["p"]).alias("off")))))))
    found = [_verified(words, hits, t, template, sum(1 for _, u, _ in index if u == t))
             for t, template in enumerate(templates)]
    verified = F.concat(*found)
    return F.when(F.arrays_overlap(words, _strings(posted)), verified).otherwise(F.array().cast(kind))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan_licenses(docs: DataFrame, templates=TEMPLATES, rare: int = RARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row."""
    worded = docs.select("doc_id", words_of(lower_ascii(F.col("text")), LETTER_GAP).alias("words"))
    index = rare_index(worded, templates, rare)
    words = F.col("words")
    found = worded.select("doc_id", F.size(words).cast("long").alias("n_words"),
                          base_places(words).alias("places"), aligned(words, index, templates).alias("found"))
    base = F.transform("places", lambda x: x["label"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda x: x["at"])).alias("first_word"),
        F.array_max(F.transform("places", lambda x: x["at"])).alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.concat(base, F.transform("found", lambda x: x["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0)).alias("score"))


def _sql() -> str:
    """DuckDB SQL: every start of a key phrase, tested word by word."""
    def phrase(words: list[str], i: str) -> str:
        return " AND ".join(f"words[{i} + {k + 1}] = '{w}'" for k, w in enumerate(words))

    def starts(words: list[str]) -> str:
        return (f"CASE WHEN list_contains(words, '{max(words, key=len)}') THEN "
                f"list_filter(range(len(words)), lambda i: coalesce({phrase(words, 'i')}, false)) ELSE [] END")

    base = " || ".join(f"list_transform({starts(p.split())}, lambda i: {{'at': i, 'label': '{lab}'}})" for lab, p in BASE)
    found = []
    for label, text, key in TEMPLATES:
        run, inner = text.split(), key.split()
        at = _run(run, inner)
        share = " + ".join(f"coalesce((i - {at} + {k} >= 0 AND words[i - {at} + {k + 1}] = '{w}')::INT, 0)"
                           for k, w in enumerate(run))
        found.append(f"list_transform({starts(inner)}, lambda i: {{'label': '{label}', 'score': ({share})::DOUBLE / {len(run)}.0::DOUBLE}})")
    return f"""
WITH worded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
found AS (SELECT doc_id, words, {base} AS places, {" || ".join(found)} AS found FROM worded)
SELECT doc_id, len(words)::BIGINT AS n_words, len(places)::BIGINT AS n_base,
       list_min(list_transform(places, lambda x: x.at))::BIGINT AS first_word,
       list_max(list_transform(places, lambda x: x.at))::BIGINT AS last_word,
       coalesce(list_aggregate(list_sort(list_distinct(list_transform(places, lambda x: x.label))), 'string_agg', ','), '') AS base_labels,
       coalesce(list_aggregate(list_sort(list_distinct(list_transform(places, lambda x: x.label) || list_transform(found, lambda x: x.label))), 'string_agg', ','), '') AS labels,
       coalesce(list_max(list_transform(found, lambda x: x.score)), 0.0::DOUBLE) AS score
FROM found
"""


SCAN_SQL = _sql()
