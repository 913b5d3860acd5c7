"""Hand-made pages and links."""

import pytest

from insight.functions.html import body_text, decode_entities, link_targets, resolve_url
from insight.operators.search import search_pages, search_posts


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn("x").alias("y")).first()["y"]


@pytest.mark.parametrize("page,text", [
    ("<body>a<b>b</b> c<p>d</p></body>", "ab c d"),
    ("<html><head><title>t</title></head>no <i>body</i> tag", "no body tag"),
    ("plain", "plain"),
    ("<body>a<script>var t='</p>';</script>b<style>p{}</style><!-- c -->d", "a b d"),
    ("<body>shown<script>never closed", "shown"),
    ("<body>shown<!-- never closed", "shown"),
    ("<body class='x'>caf&eacute; &#233; &#xE9; &amp;lt; &bogus; &copy;", "caf\u00e9 \u00e9 \u00e9 &lt; &bogus; \u00a9"),
    ("<BODY>A&nbsp;B\t\n C</BODY>after", "A B C"),
    ("", ""), (None, None),
])
def test_body_text(spark, page, text):
    assert one(spark, page, body_text) == text


@pytest.mark.parametrize("text,want", [
    ("&amp;amp;", "&amp;"), ("a & b &", "a & b &"), ("&#0;&#1114112;&#xD800;", "&#0;&#1114112;&#xD800;"), ("&#128512;", "\U0001F600"),
    ("&apos;&quot;&hellip;", "'\"\u2026"), ("&euro;5", "\u20ac5"), ("x", "x"),
])
def test_entities(spark, text, want):
    assert one(spark, text, decode_entities) == want


def test_links_of_all_quotings(spark):
    page = """<a href="/a">1</a><A class=x HREF='/b'>2</A><a href=/c>3</a><a href = "/d e">4</a><a data-href="/no">5</a><a>6</a><area href="/no">"""
    assert one(spark, page, link_targets) == ["/a", "/b", "/c", "/d e"]


@pytest.mark.parametrize("base,href,want", [
    ("https://h.org", "page.html", "https://h.org/page.html"),
    ("https://h.org", "/x", "https://h.org/x"),
    ("http://h.org/a/b/c", "../x", "http://h.org/a/x"),
    ("http://h.org/a/b/c", "./x", "http://h.org/a/b/x"),
    ("http://h.org/a/b/c", "../../../x", "http://h.org/x"),
    ("http://h.org/a/b/c", "..", "http://h.org/a/"),
    ("http://h.org/a/b/c", ".", "http://h.org/a/b/"),
    ("http://h.org/a/b?q=1#f", "x", "http://h.org/a/x"),
    ("http://h.org/a/b?q=1#f", "#g", "http://h.org/a/b?q=1#g"),
    ("http://h.org/a/b?q=1#f", "?r=2", "http://h.org/a/b?r=2"),
    ("http://h.org/a/b", "//k.net/z", "http://k.net/z"),
    ("http://h.org/a/b", "mailto:x@y", "mailto:x@y"),
    ("http://h.org/a/b", "/p/../q?x=/../y", "http://h.org/q?x=/../y"),
    ("http://h.org/a/b", "x?a=1&amp;b=2", "http://h.org/a/x?a=1&b=2"),
])
def test_links_resolve(spark, base, href, want):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    assert df.select(resolve_url("h", "b").alias("y")).first()["y"] == want


def test_page_search_parses_the_body_once(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", "<body>the cat and dog"), (2, "http://b.net/x", "<body>the and"),
                                (3, "http://a.org/y", "<body>the<script>and")], "page_id long, url string, html string")
    out = search_pages(df, ["the", "and"], ["b.net"])
    assert [r["page_id"] for r in out.collect()] == [1]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(html") == 1


def test_post_search_has_no_limit_unless_asked(spark):
    df = spark.range(3000).selectExpr("id as post_id", "concat('the post ', id) as text")
    assert search_posts(df, ["the"]).count() == 3000
    assert [r["post_id"] for r in search_posts(df, ["the"], max_results=3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("page,tag,want", [
    ("<div>a<div>b</div>c</div>d<div>e</div>", "div", "a<div>b</div>c e"),
    ("x<DIV class=y>a</DIV>", "div", "a"), ("<div>open <a href=x>", "div", "open <a href=x>"), ("</div>a<div>b</div>", "div", "b"),
    ("<divx>a</divx><div>b</div>", "div", "b"), ("no", "div", ""), ("", "div", ""), (None, "div", None),
])
def test_inner_html_of_nested_containers(spark, page, tag, want):
    from insight.functions.html import inner_html
    assert one(spark, page, lambda c: inner_html(c, tag)) == want


RESULT = [("inside", None, "mw"), ("inside", None, "g"), ("inside", None, "r"), ("child", "a", None)]


@pytest.mark.parametrize("page,want", [
    ('<div class="mw"><div class=g><p class="x r"><a href="/1">t</a></p></div></div>', ["/1"]),
    ('<div class="mw"><div><div class=g><i class=r><b><a href="/no"></a></b></i></div></div></div>', []),  # not a child
    ('<div class="mw"><div class=g></div><i class=r><a href="/no"></a></i></div>', []),  # beside, not inside
    ('<div class="mw g r"><a href="/no"></a></div>', []),  # three elements, not one
    ('<div class=mw><div class=g><br><img src=x><input/><span class=r><a href=/2>t</a><a class=z HREF=\'/3\'>u</a></span></div></div>', ["/2", "/3"]),
    ('<div class=mw><div class=g><div class=r><div class=r><a href=4></a></div><a href=5></a></div></div></div><a href=6>', ["4", "5"]),
    ('<div class=mw><div class=g><div class=r></b><a href=7></a></span></div></div>', ["7"]),  # stray end tags
    ('<div class=mw><!-- <div class=g><div class=r> --><a href=8></a></div>', []), ("<a href=9>", []), ("", []), (None, []),
])
def test_links_of_a_chain_of_elements(spark, page, want):
    from insight.functions.html import selected_links
    assert one(spark, page, lambda c: selected_links(c, RESULT)) == want


def test_page_links_in_a_scope(spark):
    from insight.operators.search import page_links
    df = spark.createDataFrame([(1, "http://a.org/x/", "<a href=0></a><ul><li><a href='y'></a><div><a href=z></a></div></li></ul>")],
                               "page_id long, url string, html string")
    out = page_links(df, container=[("inside", "li", None), ("inside", "a", None)]).collect()
    assert [(r["pos"], r["link"]) for r in out] == [(1, "http://a.org/x/y"), (2, "http://a.org/x/z")]
    assert [r["href"] for r in page_links(df, container="div").collect()] == ["z"]
