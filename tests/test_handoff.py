"""Crawl-to-text hand-off (IO4 on the documents and pages tables) and the
container-scoped link extraction."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from insight.functions.text import flatten_whitespace
from insight.operators.search import page_links
from insight.plans.text import export_page_text, export_post_search
from insight.sources import read_lines
from insight.sources.tables import read_table


def _dir():
    return tempfile.mkdtemp(prefix="insight-handoff-", dir=os.environ.get("TMPDIR", "/tmp"))


def test_post_export_round_trip(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    out = os.path.join(_dir(), "posts")
    export_post_search(docs, ["the"], out, key="doc_id")
    back = sorted(r["text"] for r in read_lines(spark, out).collect())
    want = sorted(r["t"] for r in docs.filter(F.col("text").rlike("(?i)(^|[^A-Za-z0-9])the([^A-Za-z0-9]|\\z)"))
                  .select(flatten_whitespace("text").alias("t")).collect())
    assert back == want and len(back) > 0


def test_page_text_export_one_line_per_page(spark):
    pages = read_table(spark, SF_SMALL, "pages")
    out = os.path.join(_dir(), "pages")
    export_page_text(pages, out)
    back = read_lines(spark, out)
    assert back.count() == pages.count()
    assert back.filter(F.col("text").contains("\t")).count() == 0


def test_links_scoped_to_container(spark):
    df = spark.createDataFrame([(1, "http://h.org/p", "<nav><a href=\"/a\">a</a></nav><a href=\"/b\">b</a>")],
                               "page_id long, url string, html string")
    assert [r["link"] for r in page_links(df, container="nav").collect()] == ["http://h.org/a"]
    assert [r["pos"] for r in page_links(df).orderBy("pos").collect()] == [1, 2]
