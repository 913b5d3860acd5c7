"""Search over stored posts and pages (IO6, IO7, FL6, ST1, SC14, SC15, UF3).

The reference queried live services (a post-search API, a web search engine
driven by a browser).  Here the same query semantics run as predicates over
stored tables: every listed word required (whole ASCII word, any case),
re-posts excluded, a site and its sub-domains excluded, result cap where the
reference had one.  All predicates are JVM expressions evaluated inside the
scan stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.functions.html import body_text, inner_html, link_targets, resolve_url, selected_links, url_host
from insight.functions.text import contains_word, flatten_whitespace

REPOST_PREFIX = "RT @"


def all_words(text: Column, terms: Sequence[str]) -> Column:
    cond = F.lit(True)
    for t in terms:
        cond = cond & contains_word(text, t)
    return cond


def search_posts(posts: DataFrame, terms: Sequence[str], key: str | Sequence[str] = "post_id", text: str = "text",
                 repost_prefix: str | None = REPOST_PREFIX, max_results: int | None = None) -> DataFrame:
    """IO6: posts holding every term, re-posts (``RT @...``) left out, newlines
    flattened.  All of them; ``max_results`` keeps the first ones in key order,
    as a search service does (SO5)."""
    keys = [key] if isinstance(key, str) else list(key)
    t = F.col(text)
    cond = all_words(t, terms)
    if repost_prefix is not None:
        cond = cond & ~F.coalesce(t.startswith(repost_prefix), F.lit(False))
    out = posts.filter(cond).select(*keys, flatten_whitespace(t, "\n").alias(text))
    if max_results is not None:
        out = out.orderBy(*keys).limit(max_results)
    return out


def site_excluded(url: Column, sites: Sequence[str]) -> Column:
    """True when the URL's host is one of ``sites`` or a sub-domain of one."""
    host = url_host(url)
    cond = F.lit(False)
    for s in sites:
        s = s.lower()
        cond = cond | (host == s) | host.endswith("." + s)
    return cond


def search_pages(pages: DataFrame, terms: Sequence[str], exclude_sites: Sequence[str] = (),
                 key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """IO7: pages whose visible body text holds every term, excluded sites dropped.

    Output ``(page_id, url, host)``.
    """
    u = F.col(url)
    pages = pages.select(key, url, html)
    if exclude_sites:
        pages = pages.filter(~site_excluded(u, exclude_sites))
    # one body parse for all terms
    holds = F.exists(F.array(body_text(F.col(html))), lambda t: all_words(t, terms))
    return pages.filter(holds).select(F.col(key), u, url_host(u).alias("host"))


def page_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
               container: str | Sequence[tuple] | None = None) -> DataFrame:
    """SC14 + ST1: every anchor target of every page, ``(page_id, pos, href, link)``.

    ``pos`` is the 1-based position within the page, so ordering by
    ``(page_id, pos)`` is the appended result list.  ``container`` limits the
    anchors to the inner HTML of that tag or, as a chain of steps, to those that
    :func:`insight.functions.html.selected_links` finds.
    """
    if container is None or isinstance(container, str):
        hrefs = link_targets(F.col(html) if container is None else inner_html(F.col(html), container))
    else:
        hrefs = selected_links(F.col(html), container)
    exploded = pages.select(F.col(key), F.col(url), F.posexplode(hrefs).alias("pos", "href"))
    return exploded.select(key, (F.col("pos") + 1).alias("pos"), "href",
                           resolve_url(F.col("href"), F.col(url)).alias("link"))


def page_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """SC15 + UF3: ``(page_id, url, content)``; parallelism is the partitioning."""
    return pages.select(F.col(key), F.col(url), body_text(F.col(html)).alias("content"))
