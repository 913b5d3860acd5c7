"""Plain versions and odd inputs for the operator tests."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "score double, size string, kept string, n_words string, label string, hits string, row_id string, signed string")


def spaced(text):
    return SPACED.findall(text or "")


def lettered(text):
    return LETTERED.findall((text or "").translate(LOWER))


def docs_frame(spark, rows):
    """Documents with further columns whose names operators use for themselves."""
    full = [(i, t, lang, src, None if t is None else len(t), 0.5, "x", "y", "z", "l", "h", "r", "s") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Nulls everywhere, empty, blank and wordless texts, repeats, ties, a long text, non-ASCII words."""
    body = " ".join(f"word{i % 37} of a plain text, number {i}." for i in range(40))
    return [
        (1, body, "en", "a"), (1, body, "en", "a"), (2, body, "en", "a"), (3, None, None, None), (None, body, None, "b"),
        (None, None, None, None), (4, "", "en", ""), (5, " \t\n ", "en", "a"), (6, "!!! ... ***", "en", None),
        (7, "one", "de", "b"), (8, "École été œuvre ñandú Straße 漢字 😀 end", "fr", "c"),
        (9, "\n".join(["same line here"] * 4), "en", "c"), (10, "long " * 60_000, "en", "a"),
        (11, "x" * 300_000, "en", "b"), (12, "a\x00b\x1fc\x7fd", "en", "b"),
    ]


LABELS = "doc_id bigint, quality int, toxic int, extra string"
NO_LABELS: list = []


def labels_frame(spark, rows):
    return spark.createDataFrame([(*r, "e") for r in rows], LABELS)


def odd_labels():
    return [(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, 1, 1), (9, 0, 0), (8, 1, 0), (7, None, None), (99, 1, 0)]
