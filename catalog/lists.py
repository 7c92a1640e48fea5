"""List pages to items, step by step and as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import AS_OF, Tables, query
from catalog.sqltext import clean
from edictum.functions.text import clean_html_text
from edictum.operators import listing
from edictum.operators.registry import LI, NOISE_TITLES, PAGE_HREF

# ---------------------------------------------------------------- the given pages: every link is an item

PAGE_LI = r"""li AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1)) AS li,
 generate_subscripts(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1), 1) - 1 AS pos FROM pages)"""
A = r'(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>'


def page_rows(t: Tables):
    return t.pages().select("page_id", F.lit("web").alias("source"), F.col("url").alias("base"), "html")


def entries(t: Tables):
    return page_rows(t).select("page_id", "base", F.inline(listing.list_entries(F.col("html"))))


@query("list_candidates", f"WITH {PAGE_LI} SELECT page_id, pos, li FROM li")
def _(t: Tables):
    found = F.posexplode(F.regexp_extract_all("html", F.lit(LI), F.lit(1))).alias("pos", "li")
    return page_rows(t).select("page_id", found)


@query("list_anchors", f"WITH {PAGE_LI} SELECT page_id, pos, regexp_extract(li, '{A}', 1) AS href, regexp_extract(li, '{A}', 2) AS body FROM li WHERE regexp_matches(li, '{A}')")
def _(t: Tables):
    return entries(t).select("page_id", "pos", "href", "body")


@query("list_title_length", f"WITH {PAGE_LI} SELECT page_id, pos FROM li WHERE length({clean(f'regexp_extract(li, {chr(39)}{A}{chr(39)}, 2)')}) >= 4")
def _(t: Tables):
    return entries(t).where(F.length(clean_html_text(F.col("body"))) >= 4).select("page_id", "pos")


@query(
    "list_items_of_pages",
    f"""WITH {PAGE_LI}, a AS (SELECT page_id, pos, url, regexp_extract(li, '{A}', 1) AS href, {clean(f'regexp_extract(li, {chr(39)}{A}{chr(39)}, 2)')} AS title FROM li)
    SELECT page_id, pos, concat(regexp_extract(url, '^[a-z]+://[^/?#]*', 0), href) AS url, title, '' AS date FROM a WHERE length(title) >= 4""",
)
def _(t: Tables):
    """The whole list parser over the given pages; their links have no file suffix."""
    return listing.list_items(page_rows(t), href_re=".").drop("source")


# ---------------------------------------------------------------- list pages derived from documents

LIST_LI = r"""li AS (SELECT page_id, source, base, unnest(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1)) AS li,
 generate_subscripts(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1), 1) - 1 AS pos FROM v_list_pages),
links AS (SELECT *, regexp_extract(li, '(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>(.*)', 1) AS href,
 regexp_extract(li, '(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>(.*)', 2) AS body FROM li WHERE regexp_matches(li, '<a[^>]+href="'))"""
NOISE = " OR ".join(f"contains(title, '{w}')" for w in NOISE_TITLES)
ITEMS = f"""{LIST_LI},
titled AS (SELECT *, {clean('body')} AS title FROM links WHERE regexp_matches(lower(href), '\\.s?html?$')),
items AS (SELECT page_id, pos, source, concat('https://www.example.org', replace(href, '..', '')) AS url, title,
 CASE pos WHEN 0 THEN regexp_extract(li, '<span>([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})</span>$', 1) ELSE '2024-03-07' END AS date
 FROM titled WHERE length(title) >= 4 AND NOT ({NOISE}))"""


def list_pages(t: Tables):
    return t.view("v_list_pages")


@query("list_href_suffix", f"WITH {LIST_LI} SELECT page_id, pos, href FROM links WHERE regexp_matches(lower(href), '\\.s?html?$')")
def _(t: Tables):
    found = list_pages(t).select("page_id", F.inline(listing.list_entries(F.col("html"))))
    return found.where(F.col("href").rlike(PAGE_HREF)).select("page_id", "pos", "href")


@query("list_noise_titles", f"WITH {LIST_LI} SELECT page_id, pos, body AS title FROM (SELECT *, body AS title FROM links) x WHERE {NOISE}")
def _(t: Tables):
    found = list_pages(t).select("page_id", F.inline(listing.list_entries(F.col("html"))))
    return found.where(listing.is_noise(F.col("body"))).select("page_id", "pos", F.col("body").alias("title"))


@query("list_items", f"WITH {ITEMS} SELECT * FROM items")
def _(t: Tables):
    return listing.list_items(list_pages(t))


@query("list_item_urls", f"WITH {ITEMS} SELECT page_id, pos, url FROM items")
def _(t: Tables):
    return listing.list_items(list_pages(t)).select("page_id", "pos", "url")


@query("list_item_dates", f"WITH {ITEMS} SELECT page_id, pos, date FROM items")
def _(t: Tables):
    return listing.list_items(list_pages(t)).select("page_id", "pos", "date")


@query("list_directories", f"WITH {ITEMS} SELECT page_id, pos, url FROM items WHERE url LIKE 'https://www.example.org/art/%' OR url LIKE 'https://www.example.org/zz/%'")
def _(t: Tables):
    pages = list_pages(t).withColumn("keep_paths", F.array(F.lit("/art/"), F.lit("/zz/")))
    return listing.list_items(pages).select("page_id", "pos", "url")


@query("list_item_url_pattern", f"WITH {ITEMS} SELECT page_id, pos, url FROM items WHERE source <> 'src1' OR regexp_matches(url, '/art/[0-9]*[02468]\\.html')")
def _(t: Tables):
    pattern = F.when(F.col("source") == "src1", F.lit(r"/art/[0-9]*[02468]\.html"))
    return listing.list_items(list_pages(t).withColumn("item_url_re", pattern)).select("page_id", "pos", "url")


def registry(t: Tables):
    """Half of the sources, with and without directories of their own."""
    known = t.sql("SELECT DISTINCT source AS id FROM documents WHERE CAST(substr(source, 4) AS INT) % 2 = 0")
    return known.selectExpr(
        "id",
        "'' AS base",
        "'https://www.example.org/doc/' AS list_url",
        "if(id = 'src2', array('/art/'), array()) AS keep_paths",
        "CAST(NULL AS STRING) AS item_url_re",
    )


KNOWN = "CAST(substr(source, 4) AS INT) % 2 = 0"


@query(
    "list_items_by_registry",
    f"""WITH {ITEMS} SELECT page_id, pos, source, url, title, date FROM items WHERE {KNOWN}
    AND url LIKE CASE WHEN source = 'src2' THEN 'https://www.example.org/art/%' ELSE 'https://www.example.org/doc/%' END""",
)
def _(t: Tables):
    """Pages meet their source's row; a source without directories keeps its list page's."""
    return listing.parse_list_pages(list_pages(t), registry(t))


@query("list_unknown_sources", f"SELECT page_id, source FROM v_list_pages WHERE NOT ({KNOWN})")
def _(t: Tables):
    return listing.unknown_sources(list_pages(t), registry(t)).select("page_id", "source")


@query("list_recent", f"WITH {ITEMS} SELECT page_id, pos, date FROM items WHERE DATE '{AS_OF}' - CAST(date AS DATE) <= 90")
def _(t: Tables):
    return listing.recent_items(listing.list_items(list_pages(t)), 90, AS_OF).select("page_id", "pos", "date")


@query("list_recent_unreadable", f"WITH {ITEMS} SELECT page_id, pos FROM items WHERE page_id % 3 <> 2 OR DATE '{AS_OF}' - CAST(date AS DATE) <= 30")
def _(t: Tables):
    """Undated items and dates that cannot be read count as recent."""
    items = listing.list_items(list_pages(t)).withColumn(
        "date", F.expr("CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '2024-02-31' ELSE date END")
    )
    return listing.recent_items(items, 30, AS_OF).select("page_id", "pos")


FIRST = "SELECT page_id, pos, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY page_id, pos) AS n FROM items) x WHERE n <= "


@query("list_first_items", f"WITH {ITEMS} {FIRST} 50")
def _(t: Tables):
    return listing.first_items(listing.list_items(list_pages(t)), 50).select("page_id", "pos", "source")


@query("list_first_items_many", f"WITH {ITEMS} {FIRST} 1200")
def _(t: Tables):
    """A large cut goes by row numbers instead of one sort per source."""
    return listing.first_items(listing.list_items(list_pages(t)), 1200).select("page_id", "pos", "source")


@query("list_tsv", f"WITH {ITEMS} SELECT date, title, url FROM items")
def _(t: Tables):
    return listing.tsv_lines(listing.list_items(list_pages(t)))
