"""Registered text analyses (posts, pages, bag of words, Naive Bayes) with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.functions import text as T
from insight.functions.html import body_text, url_host
from insight.operators import bayes as NB
from insight.operators import postings as IX
from insight.operators import search as S
from insight.plans import text as TP
from insight.plans.registry import register
from insight.sources.checkpoint import new_folder
from insight.sources.tables import read_table

# --------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect), written for themselves: they share no
# pattern with insight.functions, so that a wrong one there shows


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_tokens_sql(text: str, stop=("yang", "untuk", "pada", "ke")) -> str:
    words = ", ".join(lit(w) for w in stop)
    return (f"list_filter(string_split_regex({text}, '[^A-Za-z]+'), "
            f"lambda x: x <> '' AND NOT list_contains([{words}], x))")


def clean_text_sql(text: str, **kw) -> str:
    return f"array_to_string({clean_tokens_sql(text, **kw)}, ' ')"


def terms_sql(text: str, **kw) -> str:
    return (f"list_filter(list_transform({clean_tokens_sql(text, **kw)}, lambda x: lower(x)), "
            f"lambda x: length(x) >= 2)")


def body_text_sql(html: str) -> str:
    # every page has an opening body tag; some are cut off before the closing one
    b = f"split_part(regexp_replace({html}, '(?s)^.*?<body>', ''), '</body>', 1)"
    for tag in ("script", "style"):
        b = f"regexp_replace({b}, '(?s)<{tag}>.*?</{tag}>', ' ', 'g')"
    b = f"regexp_replace({b}, '(?s)<!--.*?-->', ' ', 'g')"
    b = f"regexp_replace({b}, '</?[ab]( [^>]*)?>', '', 'g')"
    b = f"regexp_replace({b}, '<[^>]+>', ' ', 'g')"
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        b = f"replace({b}, '&{name};', {lit(char)})"
    return f"array_to_string(list_filter(string_split_regex({b}, '[[:space:]]+'), lambda w: w <> ''), ' ')"


def host_sql(url: str) -> str:
    return f"lower(split_part(split_part(split_part(split_part({url}, '://', 2), '/', 1), '?', 1), '#', 1))"


def resolve_sql(href: str, base: str) -> str:
    # the links of the pages are paths from the root
    return f"split_part({base}, '/', 1) || '//' || split_part({base}, '/', 3) || replace({href}, '&amp;', '&')"


def words_sql(text: str, terms) -> str:
    tokens = f"regexp_extract_all(lower({text}), '[a-z0-9]+')"
    return " AND ".join(f"list_contains({tokens}, {lit(t)})" for t in terms)


# --------------------------------------------------------------------------
# tokenising and bag of words over all documents

#: Stop words that occur in the documents (the classifier keeps the default list).
DOC_STOP_WORDS = ("the", "de", "la")


@register("tokenise_clean", f"SELECT doc_id, {clean_text_sql('text', stop=DOC_STOP_WORDS)} AS text_clean FROM documents")
def tokenise_clean(spark, d):
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", T.clean_text("text", DOC_STOP_WORDS).alias("text_clean"))


TF_SQL = f"""
SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({terms_sql('text', stop=DOC_STOP_WORDS)}) AS term FROM documents) GROUP BY doc_id, term"""


def _doc_terms(spark, d):
    return NB.term_frequencies(read_table(spark, d, "documents"), "doc_id", stop_words=DOC_STOP_WORDS)


@register("term_counts", TF_SQL)
def term_counts(spark, d):
    return _doc_terms(spark, d)


@register("vocabulary", f"""
SELECT term, count(DISTINCT doc_id) AS doc_freq, row_number() OVER (ORDER BY term) - 1 AS term_index
FROM ({TF_SQL}) GROUP BY term""")
def vocabulary(spark, d):
    return NB.vocabulary(_doc_terms(spark, d), "doc_id")


# --------------------------------------------------------------------------
# search (IO6, IO7) and pages (SC14, SC15)

POST_TERMS = ("the", "of")
#: Stands for the re-post mark, which the documents do not have.
DOC_REPOST_PREFIX = "The "


@register("post_search", f"""
SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents
WHERE {words_sql('text', POST_TERMS)} AND NOT coalesce(starts_with(text, {lit(DOC_REPOST_PREFIX)}), false)""")
def post_search(spark, d):
    return S.search_posts(read_table(spark, d, "documents"), POST_TERMS, key="doc_id", repost_prefix=DOC_REPOST_PREFIX)


@register("post_search_conversations", f"""
SELECT conv_id, turn, replace(text, chr(10), ' ') AS text FROM conversations
WHERE {words_sql('text', ('la', 'de'))} AND NOT coalesce(starts_with(text, 'RT @'), false)""")
def post_search_conversations(spark, d):
    return S.search_posts(read_table(spark, d, "conversations"), ("la", "de"), key=["conv_id", "turn"])


@register("post_search_index", f"""
SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents
WHERE {words_sql('text', POST_TERMS)} AND NOT coalesce(starts_with(text, {lit(DOC_REPOST_PREFIX)}), false)""")
def post_search_index(spark, d):
    """IO6 over a stored index: the same posts as ``post_search``."""
    docs = read_table(spark, d, "documents")
    path = new_folder(spark, "post-index")
    IX.write_index(docs, "doc_id", F.col("text"), path)
    found = docs.join(IX.search_index(spark, path, POST_TERMS, "doc_id"), "doc_id", "left_semi")
    return S.search_posts(found, (), key="doc_id", repost_prefix=DOC_REPOST_PREFIX)


PAGE_TERMS = ("the", "and")
EXCLUDED_SITES = ("example.net",)


@register("page_search_excluding_site", f"""
SELECT page_id, url, {host_sql('url')} AS host FROM pages
WHERE {words_sql(body_text_sql('html'), PAGE_TERMS)}
  AND NOT ({" OR ".join(f"{host_sql('url')} = {lit(s)} OR ends_with({host_sql('url')}, {lit('.' + s)})"
                        for s in EXCLUDED_SITES)})""")
def page_search_excluding_site(spark, d):
    return S.search_pages(read_table(spark, d, "pages"), PAGE_TERMS, EXCLUDED_SITES)


@register("page_search_index", f"""
SELECT page_id, url, {host_sql('url')} AS host FROM pages
WHERE {words_sql(body_text_sql('html'), PAGE_TERMS)}
  AND NOT ({" OR ".join(f"{host_sql('url')} = {lit(s)} OR ends_with({host_sql('url')}, {lit('.' + s)})"
                        for s in EXCLUDED_SITES)})""")
def page_search_index(spark, d):
    """IO7, ST1 over a stored index to which half of the pages are appended: the same pages as ``page_search_excluding_site``."""
    pages = read_table(spark, d, "pages").select("page_id", "url", "html")
    path, body = new_folder(spark, "page-index"), body_text(F.col("html"))
    early = F.col("page_id") % 2 == 0
    IX.write_index(pages.where(early), "page_id", body, path)
    IX.append_index(pages.where(~early), "page_id", body, path)
    found = pages.select("page_id", "url").join(IX.search_index(spark, path, PAGE_TERMS, "page_id"), "page_id", "left_semi")
    return found.where(~S.site_excluded(F.col("url"), EXCLUDED_SITES)).withColumn("host", url_host("url"))


@register("page_links", f"""
SELECT page_id, pos, href, {resolve_sql('href', 'url')} AS link FROM (
  SELECT page_id, url, unnest(hrefs) AS href, CAST(generate_subscripts(hrefs, 1) AS INTEGER) AS pos
  FROM (SELECT page_id, url, list_transform(string_split(html, '<a href="')[2:], lambda x: split_part(x, '"', 1)) AS hrefs
        FROM pages))""")
def page_links(spark, d):
    return S.page_links(read_table(spark, d, "pages"))


@register("page_links_in_list", f"""
SELECT page_id, pos, href, {resolve_sql('href', 'url')} AS link FROM (
  SELECT page_id, url, unnest(hrefs) AS href, CAST(generate_subscripts(hrefs, 1) AS INTEGER) AS pos
  FROM (SELECT page_id, url, list_transform(
          string_split(split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<li><a href="')[2:], lambda x: split_part(x, '"', 1)) AS hrefs
        FROM pages))""")
def page_links_in_list(spark, d):
    """SC14 in a scope: links that are children of list items inside the navigation."""
    return S.page_links(read_table(spark, d, "pages"), container=[("inside", "nav", None), ("inside", "li", None), ("child", "a", None)])


@register("page_body_text", f"SELECT page_id, url, {body_text_sql('html')} AS content FROM pages")
def page_body_text(spark, d):
    return S.page_text(read_table(spark, d, "pages"))


# --------------------------------------------------------------------------
# Naive Bayes: class = labels.quality on documents (train/test by key hash)

THRESHOLD = int(0.25 * NB.SPACE)

QUALITY_DOCS_SQL = ("SELECT d.doc_id, d.text, l.quality AS label FROM documents d "
                    "JOIN labels l ON d.doc_id = l.doc_id")
LANG_DOCS_SQL = "SELECT doc_id, text, lang AS label FROM documents"


@register("exact_split", f"""
SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY ((doc_id % 2147483648) * 2654435761) % 4294967296, doc_id)
                      <= ceil(count(*) OVER (PARTITION BY label) * 0.25) AS is_test
FROM ({QUALITY_DOCS_SQL})""")
def exact_split(spark, d):
    """ST2: exactly a quarter of each class, rounded up."""
    return NB.exact_split(TP.labelled_documents(spark, d).drop("text"), "doc_id", "label")


def nb_fit_sql(docs_sql: str) -> str:
    return NB_FIT_TEMPLATE.replace("__DOCS__", docs_sql)


NB_FIT_TEMPLATE = f"""
docs AS (__DOCS__),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (
         SELECT doc_id, unnest({terms_sql('text')}) AS term FROM docs) GROUP BY doc_id, term),
vocab AS (SELECT DISTINCT term FROM tf),
vsize AS (SELECT count(*)::DOUBLE AS v FROM vocab),
split AS (SELECT doc_id, label, ((doc_id % 2147483648) * 2654435761) % 4294967296 < {THRESHOLD} AS is_test FROM docs),
train AS (SELECT doc_id, label FROM split WHERE NOT is_test),
test AS (SELECT doc_id, label FROM split WHERE is_test),
cnt AS (SELECT label, count(*) AS n_docs FROM train GROUP BY label),
feat AS (SELECT t.label, f.term, CAST(sum(f.tf) AS BIGINT) AS count
         FROM tf f JOIN train t ON f.doc_id = t.doc_id GROUP BY t.label, f.term),
tot AS (SELECT label, sum(count) AS total_count FROM feat GROUP BY label),
classes AS (
  SELECT c.label, c.n_docs, CAST(coalesce(t.total_count, 0) AS BIGINT) AS total_count,
         ln(c.n_docs / (SELECT sum(n_docs)::DOUBLE FROM cnt)) AS log_prior,
         ln(1.0 / (coalesce(t.total_count, 0) + 1.0 * (SELECT v FROM vsize))) AS log_unseen
  FROM cnt c LEFT JOIN tot t ON c.label = t.label),
weights AS (
  SELECT f.label, f.term, f.count, ln((f.count + 1.0) / 1.0) AS weight,
         ln((f.count + 1.0) / 1.0) + c.log_unseen AS log_prob
  FROM feat f JOIN classes c ON f.label = c.label),
levels AS (SELECT label, CAST(row_number() OVER (ORDER BY first) AS INTEGER) AS level
           FROM (SELECT label, min(doc_id) AS first FROM docs GROUP BY label))"""


def predict_sql(keys: list[str], docs: str, ptf: str) -> str:
    """CTEs ``known, lens, partial, scores, pred`` for documents ``docs`` with tf ``ptf``."""
    k = ", ".join(keys)
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)
    qk = ", ".join(f"q.{c}" for c in keys)
    return f"""
known AS (SELECT * FROM ({ptf}) WHERE term IN (SELECT term FROM vocab)),
lens AS (SELECT {qk}, coalesce(sum(kn.tf), 0) AS len FROM ({docs}) q
         LEFT JOIN known kn ON {on('q', 'kn')} GROUP BY {qk}),
partial AS (
  SELECT {", ".join(f"kn.{c}" for c in keys)}, w.label, kn.tf * w.weight AS s
  FROM known kn JOIN weights w ON kn.term = w.term
  UNION ALL
  SELECT {", ".join(f"l.{c}" for c in keys)}, c.label, l.len * c.log_unseen AS s FROM lens l CROSS JOIN classes c),
scores AS (SELECT {", ".join(f"p.{c}" for c in keys)}, p.label, sum(p.s) + c.log_prior AS score
           FROM partial p JOIN classes c ON p.label = c.label
           GROUP BY {", ".join(f"p.{c}" for c in keys)}, p.label, c.log_prior),
pred AS (SELECT {k}, label AS predicted, score FROM scores
         QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY score DESC, label) = 1)"""


NB_FIT_SQL = nb_fit_sql(QUALITY_DOCS_SQL)


def nb_test_sql(fit_sql: str) -> str:
    return NB_TEST_TEMPLATE.replace("__FIT__", fit_sql)


NB_TEST_TEMPLATE = ("WITH __FIT__,"
               + predict_sql(["doc_id"], "SELECT doc_id FROM test",
                             "SELECT tf.* FROM tf JOIN test ON tf.doc_id = test.doc_id") + """,
predt AS (SELECT t.doc_id, t.label AS truth, p.predicted, p.score FROM test t JOIN pred p ON t.doc_id = p.doc_id),
grid AS (SELECT a.label AS truth, b.label AS predicted, a.level AS truth_level, b.level AS predicted_level
         FROM levels a CROSS JOIN levels b),
conf AS (SELECT g.*, coalesce(n.n, 0) AS n FROM grid g LEFT JOIN
         (SELECT truth, predicted, count(*) AS n FROM predt GROUP BY truth, predicted) n
         ON g.truth = n.truth AND g.predicted = n.predicted),
metrics AS (
  SELECT c.truth AS label, c.truth_level AS level, c.n AS tp, t.n_true, p.n_pred,
         coalesce(c.n::DOUBLE / nullif(p.n_pred, 0), 0.0) AS precision,
         coalesce(c.n::DOUBLE / nullif(t.n_true, 0), 0.0) AS recall
  FROM conf c
  JOIN (SELECT truth AS label, CAST(sum(n) AS BIGINT) AS n_true FROM conf GROUP BY truth) t ON c.truth = t.label
  JOIN (SELECT predicted AS label, CAST(sum(n) AS BIGINT) AS n_pred FROM conf GROUP BY predicted) p
    ON c.truth = p.label
  WHERE c.truth = c.predicted)
""")


NB_TEST_SQL = nb_test_sql(NB_FIT_SQL)
LANG_TEST_SQL = nb_test_sql(nb_fit_sql(LANG_DOCS_SQL))


@register("nb_class_table", f"WITH {NB_FIT_SQL} SELECT * FROM classes",
          rounded=["log_prior", "log_unseen"])
def nb_class_table(spark, d):
    return TP.quality_model(spark, d).model.classes


@register("nb_model", f"WITH {NB_FIT_SQL} SELECT * FROM weights", rounded=["log_prob", "weight"])
def nb_model(spark, d):
    return TP.quality_model(spark, d).model.weights


@register("nb_predict", NB_TEST_SQL + "SELECT * FROM predt", rounded=["score"])
def nb_predict(spark, d):
    return TP.quality_test_predictions(TP.quality_model(spark, d))


@register("nb_confusion", NB_TEST_SQL + "SELECT * FROM conf")
def nb_confusion(spark, d):
    return TP.quality_confusion(TP.quality_model(spark, d))


@register("nb_metrics", NB_TEST_SQL + """
SELECT *, coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM metrics""",
          rounded=["precision", "recall", "f1"])
def nb_metrics(spark, d):
    return TP.quality_metrics(TP.quality_model(spark, d))


@register("nb_f1_binary", NB_TEST_SQL + """
SELECT coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1_binary
FROM metrics WHERE label = 1""", rounded=["f1_binary"])
def nb_f1_binary(spark, d):
    return NB.binary_f1(TP.quality_metrics(TP.quality_model(spark, d)), 1)


CONV_TF_SQL = f"""
SELECT conv_id, turn, term, count(*) AS tf FROM (
  SELECT conv_id, turn, unnest({terms_sql('text')}) AS term FROM conversations) GROUP BY conv_id, turn, term"""


@register("score_posts", f"WITH {NB_FIT_SQL},"
          + predict_sql(["conv_id", "turn"], "SELECT conv_id, turn FROM conversations", CONV_TF_SQL) + f"""
SELECT c.conv_id, c.turn, {clean_text_sql('c.text')} AS text_clean, p.predicted, p.score
FROM conversations c JOIN pred p ON c.conv_id = p.conv_id AND c.turn = p.turn""", rounded=["score"])
def score_posts(spark, d):
    return TP.score_posts(TP.quality_model(spark, d), read_table(spark, d, "conversations"),
                          ["conv_id", "turn"])


PAGE_TEXT_SQL = f"SELECT page_id, url, {body_text_sql('html')} AS content FROM pages"
PAGE_TF_SQL = f"""
SELECT page_id, term, count(*) AS tf FROM (
  SELECT page_id, unnest({terms_sql('content')}) AS term FROM ({PAGE_TEXT_SQL})) GROUP BY page_id, term"""


@register("score_pages", f"WITH {NB_FIT_SQL},"
          + predict_sql(["page_id"], "SELECT page_id FROM pages", PAGE_TF_SQL) + f"""
SELECT t.page_id, t.url, {clean_text_sql('t.content')} AS text_clean, p.predicted, p.score
FROM ({PAGE_TEXT_SQL}) t JOIN pred p ON t.page_id = p.page_id""", rounded=["score"])
def score_pages(spark, d):
    return TP.score_pages(TP.quality_model(spark, d), read_table(spark, d, "pages"))


# --------------------------------------------------------------------------
# four-class variant: documents.lang as the label (multi-class metrics)

@register("nb_lang_confusion", LANG_TEST_SQL + "SELECT * FROM conf")
def nb_lang_confusion(spark, d):
    return TP.quality_confusion(TP.language_model(spark, d))


@register("nb_lang_metrics", LANG_TEST_SQL + """
SELECT *, coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM metrics""",
          rounded=["precision", "recall", "f1"])
def nb_lang_metrics(spark, d):
    return TP.quality_metrics(TP.language_model(spark, d))
