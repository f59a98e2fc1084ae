"""Download links in pages: q22, q23."""

from pyspark.sql import functions as F

from rollcall.operators import links as op
from rollcall.queries.tables import wide_table

# No page links to an XML file, so the needles are words the pages do hold.
NEEDLES = {
    "href_all": ("/",), "href_any": ("that", "una"), "text_all": ("e",), "text_any": ("n", "st"),
}


def _pages(spark, sf_dir):
    return wide_table(spark, sf_dir, "pages")


def q22_page_links(spark, sf_dir):
    return op.page_links(_pages(spark, sf_dir), "html", "page_id")


def q22b_link_report(spark, sf_dir):
    """Every page lacks an XML link, so every page is reported."""
    return op.missed_report(_pages(spark, sf_dir), "html", "url", "page_id")


def q23_page_best_link(spark, sf_dir):
    return op.best_link(_pages(spark, sf_dir), "html", "url", "page_id", **NEEDLES)


VARIANT = """CASE pos WHEN 0 THEN href WHEN 1 THEN substr(href, 2) WHEN 2 THEN '..' || href
  WHEN 3 THEN '?q=' || substr(href, 2) WHEN 4 THEN '#' || substr(href, 2)
  WHEN 5 THEN 'https://files.example.net' || href ELSE './a/b/../.' || href END"""


def q23b_resolve_links(spark, sf_dir):
    """Every anchor's address, rewritten into one of seven relative forms."""
    listed = op.page_links(_pages(spark, sf_dir), "html", "page_id", "url")
    return listed.withColumn("raw", F.expr(VARIANT)).select(
        "page_id", "pos", "raw", op.resolve(F.col("raw"), F.col("url")).alias("link")
    )


QUERIES = {
    "q22_page_links": q22_page_links,
    "q22b_link_report": q22b_link_report,
    "q23_page_best_link": q23_page_best_link,
    "q23b_resolve_links": q23b_resolve_links,
}

_LINKS = """
  SELECT page_id, url, i - 1 AS pos, hrefs[i] AS href, texts[i] AS text FROM (
    SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM (
      SELECT page_id, url,
        regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs,
        regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS texts FROM pages))
"""

_ORIGIN = "regexp_extract(url, '^https?://[^/]*')"
_FOLDER = f"regexp_extract(url, '^(https?://[^?#]*/)', 1)"

CHECKS = {
    "q22_page_links": f"SELECT page_id, CAST(pos AS INT) AS pos, href, text FROM ({_LINKS})",
    "q22b_link_report": f"""
      SELECT page_id, CAST(pos AS INT) AS pos, href, left(text, 50) AS text
      FROM ({_LINKS}) WHERE pos < 10
    """,
    "q23_page_best_link": f"""
      WITH l AS ({_LINKS}), found AS (
        SELECT page_id,
          arg_min(href, pos) FILTER (WHERE contains(href, '/')
            AND (contains(lower(href), 'that') OR contains(lower(href), 'una'))) AS by_href,
          arg_min(href, pos) FILTER (WHERE contains(lower(text), 'e')
            AND (contains(lower(text), 'n') OR contains(lower(text), 'st'))) AS by_text
        FROM l GROUP BY page_id)
      SELECT page_id, {_ORIGIN} || coalesce(by_href, by_text) AS link,
        CASE WHEN by_href IS NOT NULL THEN 'href' WHEN by_text IS NOT NULL THEN 'text' END AS found_by
      FROM pages LEFT JOIN found USING (page_id)
    """,
    "q23b_resolve_links": f"""
      SELECT page_id, CAST(pos AS INT) AS pos, {VARIANT} AS raw, CASE pos
        WHEN 0 THEN {_ORIGIN} || href
        WHEN 1 THEN {_FOLDER} || substr(href, 2)
        WHEN 2 THEN CASE WHEN {_FOLDER} = {_ORIGIN} || '/' THEN {_ORIGIN} || href
          ELSE regexp_replace({_FOLDER}, '[^/]+/$', '') || substr(href, 2) END
        WHEN 3 THEN regexp_extract(url, '^[^?#]*') || '?q=' || substr(href, 2)
        WHEN 4 THEN regexp_extract(url, '^[^#]*') || '#' || substr(href, 2)
        WHEN 5 THEN 'https://files.example.net' || href
        ELSE {_FOLDER} || 'a' || href END AS link
      FROM ({_LINKS})
    """,
}
