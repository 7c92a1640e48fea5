"""HTML to text, entities, URLs, document numbers and dates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Tables, query
from catalog.sqltext import clean, unescape
from catalog.views import cte
from edictum.functions.dates import first_valid_date, iso_date
from edictum.functions.text import clean_html_text, doc_number, first_nonblank
from edictum.functions.text import unescape as unescape_expr
from edictum.functions.urls import resolve_url, url_host, url_path
from edictum.sources.tables import decode_text


@query("saved_pages", "SELECT page_id, url, length(html) AS n, md5(html) AS digest FROM pages")
def _(t: Tables):
    """Pages held as bytes, read as text."""
    raw = t.table("pages").withColumn("content", F.encode("html", "UTF-8"))
    html = decode_text(F.col("content"))
    return raw.select("page_id", "url", F.length(html).alias("n"), F.md5(html.cast("binary")).alias("digest"))


@query("page_text", f"SELECT page_id, {clean('html')} AS text FROM pages")
def _(t: Tables):
    return t.pages().select("page_id", clean_html_text(F.col("html")).alias("text"))


SCRIPT = "regexp_extract(html, '(?s)<script>(.*?)</script>', 1)"
SHIELDED = f"CASE WHEN {SCRIPT} = '' THEN html ELSE replace(html, {SCRIPT}, replace({SCRIPT}, '<', chr(3))) END"


@query("page_text_with_scripts", f"SELECT page_id, replace({clean(SHIELDED, drop_script=False)}, chr(3), '<') AS text FROM pages")
def _(t: Tables):
    """Whole pages, script and style text kept; tags within a script's strings are its text."""
    return t.pages().select("page_id", clean_html_text(F.col("html"), drop_script=False).alias("text"))


@query(
    "page_text_script_kept",
    """SELECT page_id, concat(regexp_extract(html, '<style>(.*?)</style>', 1), regexp_extract(html, '(?s)<script>(.*?)</script>', 1)) AS text FROM pages""",
)
def _(t: Tables):
    """A head's style and script bodies come through as they are, tags in strings included."""
    head = F.expr("regexp_extract(html, '(?s)(<style>.*?</script>)', 1)")
    return t.pages().select("page_id", clean_html_text(head, drop_script=False).alias("text"))


@query("entities", f"SELECT page_id, {unescape('html')} AS html FROM pages")
def _(t: Tables):
    return t.table("pages").select("page_id", unescape_expr(F.col("html")).alias("html"))


@query(
    "entities_numeric",
    """SELECT doc_id, concat(chr(CAST(65 + doc_id % 26 AS INT)), '中', chr(CAST(20000 + doc_id % 900 AS INT)), '–', '&nope;', '©x', '&') AS text FROM documents""",
)
def _(t: Tables):
    text = F.expr("""concat('&#', CAST(65 + doc_id % 26 AS STRING), ';', '&#x4E2d;', '&#', CAST(20000 + doc_id % 900 AS STRING),
        ';', '&#150;', '&nope;', '&copyx', '&amp')""")
    return t.table("documents").select("doc_id", unescape_expr(text).alias("text"))


@query(
    "document_numbers",
    """SELECT id, CASE WHEN doc_number = '' THEN '' ELSE regexp_extract(doc_number, '[^〔]*〔[0-9]{4}〕[0-9]*号') END AS doc_number FROM v_policies""",
)
def _(t: Tables):
    text = F.concat(F.col("content"), F.lit("。\u3000"), F.col("doc_number"), F.lit("，"))
    return t.view("v_policies", parse=True).select("id", doc_number(text).alias("doc_number"))


@query(
    "iso_dates",
    "SELECT id, CAST(publish_date AS STRING) AS found FROM v_policies",
)
def _(t: Tables):
    printed = F.expr("""concat(CAST(year(publish_date) AS STRING), CASE id % 4 WHEN 0 THEN '-' WHEN 1 THEN '/' WHEN 2 THEN '年' ELSE '.' END,
        CAST(month(publish_date) AS STRING), CASE id % 3 WHEN 0 THEN '-' WHEN 1 THEN '月' ELSE '.' END, CAST(day(publish_date) AS STRING))""")
    return t.view("v_policies").select("id", iso_date(printed).alias("found"))


@query(
    "first_valid_dates",
    "SELECT id, CASE WHEN id % 4 = 0 THEN '' ELSE CAST(publish_date AS STRING) END AS found FROM v_policies",
)
def _(t: Tables):
    text = F.expr("""concat('2026-02-00018 ', title, ' 2024-13-01 ', CASE WHEN id % 4 = 0 THEN '2024.1.45' ELSE CAST(publish_date AS STRING) END, ' 2031-01-01'
        )""")
    kept = F.expr("if(id % 4 = 0, '2024-00-00012 2024.1.45', NULL)")
    return t.view("v_policies").select("id", first_nonblank(first_valid_date(F.coalesce(kept, text))).alias("found"))


# Each case pairs a reference with the address it must lead to, seen from https://SITE/art/ID.html.
HREFS = [
    ("concat(n, '.html')", "concat(site, '/art/', n, '.html')"),
    ("concat('./a/', n)", "concat(site, '/art/a/', n)"),
    ("concat('../b/./', n, '/../c')", "concat(site, '/b/c')"),
    ("concat('../../../', n)", "concat(site, '/', n)"),
    ("concat('/r/../s/', n)", "concat(site, '/s/', n)"),
    ("concat('//cdn.x.org/', n)", "concat('https://cdn.x.org/', n)"),
    ("concat('?q=', n)", "concat(site, '/art/', n, '.html?q=', n)"),
    ("concat('#f', n)", "concat(site, '/art/', n, '.html#f', n)"),
    ("concat('mailto:', n, '@x.org')", "concat('mailto:', n, '@x.org')"),
    ("concat('HTTPS://z.org/', n, '?')", "concat('https://z.org/', n)"),
    ("'..'", "concat(site, '/')"),
    ("''", "concat(site, '/art/', n, '.html')"),
]


def _cases(side: int) -> str:
    whens = " ".join(f"WHEN {i} THEN {case[side]}" for i, case in enumerate(HREFS))
    return f"CASE id % {len(HREFS)} {whens} END"


PARTS = "SELECT id, source_url, CAST(id AS STRING) AS n, concat('https://www.', issuing_authority, '.example.org') AS site FROM v_policies"


@query("resolved_urls", f"SELECT id, {_cases(1)} AS url FROM ({PARTS}) p")
def _(t: Tables):
    pairs = t.sql(cte(f"SELECT id, source_url, {_cases(0)} AS href FROM ({PARTS}) p"))
    return pairs.select("id", resolve_url(F.col("source_url"), F.col("href")).alias("url"))


@query(
    "url_parts",
    """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)', 1) AS host,
    regexp_extract(url, '^[a-z]+://([^/?#]*)([^?#]*)', 2) AS path FROM pages""",
)
def _(t: Tables):
    return t.table("pages").select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
