"""Links and visible text of stored web pages (SC14, SC15) by regular expressions.

Visible text:

1. body = from ``<body ...>`` to ``</body>`` or, for an unclosed body, to the
   end of the page; a page without a body tag is read whole, less its head;
2. script, style and comment spans are dropped (an unclosed one to the end);
3. inline tags vanish (``a b i em strong span ...``), every other tag is a
   space (block boundary);
4. character references are decoded once: the named ones of HTML 4, ``&apos;``
   and numeric ones, decimal or hexadecimal;
5. blanks (space, tab, CR, LF, FF) are squeezed to one space and trimmed --
   this also performs the newline/tab flattening of the page text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence
from html.entities import name2codepoint

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from insight.functions.nulls import ColumnLike, col_of

# functions that run in tasks travel with the plan, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HAS_BODY = r"(?i)<body[\s>]"
BODY = r"(?is)<body[^>]*>(.*?)(</body>|\z)"
HEAD = r"(?is)<head[\s>].*?(</head>|\z)"
DROP_SPANS = r"(?is)<script[^>]*>.*?(</script>|\z)|<style[^>]*>.*?(</style>|\z)|<!--.*?(-->|\z)"
INLINE_TAGS = r"(?i)</?(a|abbr|b|code|em|i|small|span|strong|u)(\s[^>]*)?>"
ANY_TAG = r"<[^>]*>"
BLANKS = r"[ \t\r\n\f]+"
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
REFERENCE = r"^&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
URL_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
URL_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*@)?([^/?#:]*)"


def _replace(c: Column, pattern: str, rep: str) -> Column:
    return F.regexp_replace(c, pattern, rep)


def _character(code: Column) -> Column:
    """The character of a code point; null outside Unicode and for surrogates."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_entities(c: ColumnLike) -> Column:
    """Decode character references, each once; unknown ones stay as they are.

    The text is cut before every ``&``; a piece that begins with a reference has it
    replaced.  A no-break space becomes a plain one.
    """
    known = {**{k: chr(v) for k, v in name2codepoint.items()}, "apos": "'", "nbsp": " "}
    names = F.create_map(*[F.lit(x) for k, v in sorted(known.items()) for x in (k, v)])

    def decoded(piece: Column) -> Column:
        ref = F.regexp_extract(piece, REFERENCE, 1)
        digits = F.substring(ref, 2, 10)
        hexed = F.conv(F.substring(ref, 3, 10), 16, 10).cast("long")
        char = (F.when(ref.rlike("^#[xX]"), _character(hexed))
                .when(ref.startswith("#"), _character(digits.try_cast("long")))
                .when(ref != "", F.try_element_at(names, ref)))
        whole = F.concat(char, F.substring(piece, F.length(ref) + 3, F.length(piece)))
        return F.when(piece.startswith("&"), F.coalesce(whole, piece)).otherwise(piece)

    return F.array_join(F.transform(F.split(col_of(c), "(?=&)"), decoded), "")


def body_text(html: ColumnLike) -> Column:
    """SC15: visible text of the page body, one line, blanks squeezed."""
    page = col_of(html)
    body = F.when(page.rlike(HAS_BODY), F.regexp_extract(page, BODY, 1)).otherwise(_replace(page, HEAD, " "))
    body = _replace(body, DROP_SPANS, " ")
    body = _replace(body, INLINE_TAGS, "")
    body = _replace(body, ANY_TAG, " ")
    body = decode_entities(body)
    return F.trim(_replace(body, BLANKS, " "))


def inner_html(html: ColumnLike, tag: str) -> Column:
    """The inner HTML of every outermost ``<tag>...</tag>`` of the page, concatenated; the tag may be nested.

    The page is cut before its ``<tag`` and ``</tag`` marks.  A running depth over the
    pieces tells which ones lie inside; a closing mark without an opening one is ignored,
    an unclosed element runs to the end of the page.
    """
    mark = rf"(?i)(?=<{tag}[\s>/])|(?=</{tag}[\s>])"
    pieces = F.split(col_of(html), mark)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))

    def step(state: Column, piece: Column) -> Column:
        opens = piece.rlike(rf"(?i)^<{tag}[\s>/]")
        closes = piece.rlike(rf"(?i)^</{tag}[\s>]")
        depth = (F.when(opens, state["depth"] + 1).when(closes, F.greatest(state["depth"] - 1, F.lit(0)))
                 .otherwise(state["depth"]))
        outer = (opens & (state["depth"] == 0)) | (closes & (state["depth"] == 1))
        # an outermost mark itself is no content: what follows the opening one is, what follows the closing one is not
        body = F.when(outer, F.regexp_replace(piece, r"(?s)^<[^>]*>", "")).otherwise(piece)
        between = F.when(opens & (state["depth"] == 0) & (state["out"] != ""), F.lit(" ")).otherwise(F.lit(""))
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(state["out"], between, body)).otherwise(state["out"]).alias("out"))

    return F.aggregate(pieces, start, step, lambda state: state["out"])


# Elements that have no end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def selected_links(html: ColumnLike, steps: Sequence[tuple[str, str | None, str | None]]) -> Column:
    """SC14 in a scope: ``href`` of the anchors that end a chain of elements, in page order (array).

    ``steps`` lists the chain from the outside in, as (relation, tag, class): the relation
    is "inside" (at any depth) or "child"; tag or class may be None.  For example
    ``[("inside", None, "mw"), ("inside", None, "r"), ("child", "a", None)]``.

    The page's tags are read once with a stack of open elements.  Each has two sets of
    steps, as bits: those that it ends itself, and those that it or an element around it
    ends.  An end tag closes the elements up to its own start tag, one without a start tag
    nothing.  Scripts, styles and comments are left out first.  A null page has no links.
    """
    chain = [(relation, tag and tag.lower(), cls) for relation, tag, cls in steps]
    tag_at = re.compile(r"<(/?)([A-Za-z][^\s>/]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>")
    named = {n: re.compile(rf"""(?i)(?:^|\s){n}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""") for n in ("class", "href")}

    def attribute(name: str, text: str) -> str | None:
        found = named[name].search(text)
        return found and found[1].strip(found[1][0] if found[1][0] in "\"'" else "")

    def links(page: str) -> list[str]:
        out, stack = [], [("", 0, 0)]
        for end, tag, rest in tag_at.findall(page):
            tag = tag.lower()
            if end:
                at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
                del stack[at or len(stack):]
                continue
            classes = (attribute("class", rest) or "").split()
            _, parent, around = stack[-1]
            own = 0
            for k, (relation, want, cls) in enumerate(chain):
                held = k == 0 or (parent if relation == "child" else around) >> (k - 1) & 1
                if held and want in (None, tag) and (cls is None or cls in classes):
                    own |= 1 << k
            if tag == "a" and own >> (len(chain) - 1) & 1:
                href = attribute("href", rest)
                if href is not None:
                    out.append(href)
            if tag not in VOID and not rest.rstrip().endswith("/"):
                stack.append((tag, own, around | own))
        return out

    @F.pandas_udf("array<string>")
    def select(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: links(p) if p is not None else [])

    return select(_replace(col_of(html), DROP_SPANS, " "))


def link_targets(html: ColumnLike) -> Column:
    """SC14: ``href`` of every anchor, in page order (array); quotes, if any, are taken off."""
    raw = F.regexp_extract_all(col_of(html), F.lit(LINK), 1)
    return F.transform(raw, lambda x: F.regexp_replace(x, r"""^["']|["']$""", ""))


def url_host(url: ColumnLike) -> Column:
    """Lower-cased host of an absolute URL ('' when there is none)."""
    return F.lower(F.regexp_extract(col_of(url), URL_HOST, 2))


def _without_dots(url: Column) -> Column:
    """An absolute URL whose path has its ``.`` and ``..`` segments removed."""
    origin = F.regexp_extract(url, URL_ORIGIN, 1)
    path = F.regexp_extract(url, r"^[^/]*//[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(url, r"([?#].*)?$", 1)
    segments = F.split(F.substring(path, 2, 1_000_000_000), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, s: F.when(
        s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(
        F.concat(acc, F.array(s))))
    last = F.element_at(segments, -1)
    end = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    clean = F.concat(origin, F.lit("/"), F.array_join(kept, "/"), end, tail)
    return F.when(path.rlike(r"/\.\.?(/|$)"), clean).otherwise(url)


def resolve_url(href: ColumnLike, base: ColumnLike) -> Column:
    """Absolute form of ``href`` against the page URL ``base``."""
    h = decode_entities(col_of(href))
    b = col_of(base)
    origin = F.regexp_extract(b, URL_ORIGIN, 1)
    scheme = F.regexp_extract(b, URL_SCHEME, 1)
    base_doc = F.regexp_replace(b, "#.*$", "")
    base_page = F.regexp_replace(base_doc, r"\?.*$", "")
    # the folder of the page; a bare origin has the root
    base_dir = F.when(base_page == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_extract(base_page, r"^(.*/)", 1))
    return (F.when(h.rlike(URL_SCHEME), h)
            .when(h.startswith("//"), _without_dots(F.concat(scheme, F.lit(":"), h)))
            .when(h.startswith("/"), _without_dots(F.concat(origin, h)))
            .when(h.startswith("#") | (h == ""), F.concat(base_doc, h))
            .when(h.startswith("?"), F.concat(base_page, h))
            .otherwise(_without_dots(F.concat(base_dir, h))))
