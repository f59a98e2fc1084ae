"""Download links in web pages: find the anchors, pick one, make it absolute.

The anchors of a page stay an array in the page's row; picking the best one is
an array filter, not a window over exploded anchors, so nothing shuffles.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.text import contains_all, contains_any, not_empty, strip
from rollcall.operators.rows import explode_once

HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script>|\z)|<style\b.*?(?:</style>|\z)"
OPEN_ANCHOR = r"(?i)<a\s"
TAG_REST = r"""^(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
HREF = r"""(?i)(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"

# The entities decoded in addresses and link texts.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'",
    "&nbsp;": " ", "&amp;": "&",
}


def unescape(c: Column) -> Column:
    for entity, char in ENTITIES.items():  # '&amp;' last, or it would decode twice
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


REST = 1 << 30  # more entries than any page has


def _anchor(part: Column) -> Column:
    """(href, text) of one anchor, from its tag and the text behind its '<a '."""
    tag = part["tag"]
    body = F.get(
        F.split(F.substr(part["piece"], F.length(tag) + 2), r"(?i)</a\s*>", 2), F.lit(0)
    )
    href = F.when(
        tag.rlike(HREF), F.concat(*[F.regexp_extract(tag, HREF, i) for i in (1, 2, 3)])
    )
    words = F.transform(F.split(body, "<[^>]*>"), lambda t: strip(unescape(t)))
    return F.struct(unescape(href).alias("href"), F.array_join(words, "").alias("text"))


def anchors(html: Column) -> Column:
    """All anchors with an address, in page order.

    Array functions do not share work between branches, so each step of an
    anchor is bound by a transform of its own.
    """
    pieces = F.split(F.regexp_replace(html, HIDDEN, ""), OPEN_ANCHOR, -1)
    parts = F.transform(
        F.slice(pieces, F.lit(2), F.lit(REST)),
        lambda p: F.struct(p.alias("piece"), F.regexp_extract(p, TAG_REST, 0).alias("tag")),
    )
    return F.filter(F.transform(parts, _anchor), lambda a: a["href"].isNotNull())


def page_links(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """One row per anchor: (pos, href, text)."""
    found = explode_once(pages, anchors(F.col(html)), "pos", "a", *keep)
    return found.select(*keep, "pos", "a.href", "a.text")


def _without_dots(path: Column) -> Column:
    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return (
            F.when(part == "..", up).when(part == ".", done)
            .otherwise(F.concat(done, F.array(part)))
        )

    parts = F.split(path, "/", -1)
    walked = F.aggregate(parts, F.array().cast("array<string>"), step)
    last = F.element_at(parts, F.lit(-1))
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(walked, "/"), tail)


def resolve(href: Column, page_url: Column) -> Column:
    """An absolute address: site-relative and page-relative links get a base.

    A leading '/' is put behind the site's origin, also when it is doubled.
    """
    origin = F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    plain = F.regexp_replace(page_url, r"[?#].*$", "")
    path = F.substr(plain, F.length(origin) + 1)
    folder = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(path, "^/", ""), "[^/]*$", ""))
    target, rest = F.regexp_extract(href, r"^[^?#]*", 0), F.regexp_extract(href, r"[?#].*$", 0)
    joined = F.concat(origin, _without_dots(F.concat(folder, target)), rest)
    return (
        F.when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("http") | href.rlike(SCHEME), href)
        .when(href.startswith("#"), F.concat(F.regexp_replace(page_url, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(plain, href))
        .otherwise(joined)
    )


def _candidates(
    pages: DataFrame, html: str, url: str, *keep: str,
    href_all: Sequence[str] = fv.LINK_HREF_ALL, href_any: Sequence[str] = fv.LINK_HREF_ANY,
    text_all: Sequence[str] = fv.LINK_TEXT_ALL, text_any: Sequence[str] = fv.LINK_TEXT_ANY,
) -> DataFrame:
    """(anchors, by_href, by_text) per page, the last two '' or null on a miss."""

    def first_fit(field: str, needed, one_of) -> Column:
        def fits(a: Column) -> Column:
            lowered = F.lower(a[field])
            return contains_all(lowered, needed) & contains_any(lowered, one_of)

        return F.get(F.filter("anchors", fits), F.lit(0))["href"]

    return pages.select(*keep, url, anchors(F.col(html)).alias("anchors")).select(
        *keep, url, "anchors",
        first_fit("href", href_all, href_any).alias("by_href"),
        first_fit("text", text_all, text_any).alias("by_text"),
    )


def best_link(pages: DataFrame, html: str, url: str, *keep: str, **needles) -> DataFrame:
    """(link, found_by): the first anchor whose address fits, else whose text fits."""
    first = F.coalesce(F.nullif("by_href", F.lit("")), F.nullif("by_text", F.lit("")))
    return _candidates(pages, html, url, *keep, **needles).select(
        *keep,
        resolve(first, F.col(url)).alias("link"),
        F.when(not_empty(F.col("by_href")), F.lit("href"))
        .when(not_empty(F.col("by_text")), F.lit("text")).alias("found_by"),
    )


def missed_report(pages: DataFrame, html: str, url: str, *keep: str, **needles) -> DataFrame:
    """For pages without a fitting link, their first few anchors, texts cut."""
    missed = ~F.coalesce(not_empty(F.concat_ws("", "by_href", "by_text")), F.lit(False))
    shown = F.when(missed, F.slice("anchors", F.lit(1), F.lit(fv.LINK_REPORT_ROWS)))
    found = explode_once(_candidates(pages, html, url, *keep, **needles), shown, "pos", "a", *keep)
    return found.select(
        *keep, "pos", "a.href", F.left("a.text", F.lit(fv.LINK_REPORT_CHARS)).alias("text")
    )
