"""Document pages to records, and the links between records and list items."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import AS_OF, Tables, query
from catalog.lists import ITEMS
from catalog.sqltext import clean, strip
from catalog.views import cte
from edictum.operators import details, enrichment, linkage, listing
from edictum.operators.registry import rule, source_table, with_profile
from edictum.plans import offline_build

# ---------------------------------------------------------------- the given pages

H1 = clean(r"regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")
HEAD_TITLE = clean(r"regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")
ARTICLE = r"(?is)<article[^>]*>(.*?)</article>"


def web_documents(t: Tables):
    pages = t.pages().select("page_id", "url", "html")
    rules = [rule(ARTICLE, 50), rule(r"(?s)\A(.*)\z", 0)]
    return details.document_records(with_profile(pages, content_rules=rules), keep=("page_id",))


@query("page_titles", f"SELECT page_id, CASE WHEN {H1} <> '' THEN {H1} ELSE {HEAD_TITLE} END AS title FROM pages")
def _(t: Tables):
    return web_documents(t).select("page_id", "title")


ARTICLE_SQL = clean(f"regexp_extract(html, '{ARTICLE}', 1)")


@query("page_content", f"SELECT page_id, CASE WHEN length({ARTICLE_SQL}) >= 50 THEN {ARTICLE_SQL} ELSE {clean('html')} END AS content FROM pages")
def _(t: Tables):
    return web_documents(t).select("page_id", "content")


@query("page_documents", f"""SELECT page_id, url, CASE WHEN {H1} <> '' THEN {H1} ELSE {HEAD_TITLE} END AS title, '' AS publish_date, 0 AS attachments, length(html) AS raw FROM pages""")
def _(t: Tables):
    return web_documents(t).select(
        "page_id", "url", "title", "publish_date", F.size("attachments").alias("attachments"), F.length("raw_html").alias("raw")
    )


# ---------------------------------------------------------------- document pages of three kinds of site

N = "CAST(page_id AS STRING)"
HOST = "regexp_extract(url, '^https://[^/]*', 0)"
Q = chr(34)
ZOOM = clean(f"regexp_extract(html, '(?s)<div id={Q}zoom{Q}>(.*?)</div>', 1)")
MARKED = clean("regexp_extract(html, '(?s)信息内容.>begin-->(.*?)<!--', 1)")
BOX = clean(f"regexp_extract(html, '(?s)<div id={Q}xw_box{Q}>(.*?)</div>', 1)")
NUMBER = r"[^\s\x{3000}，。；、]{0,30}?[〔(][\s\x{3000}]*[0-9]{4}[\s\x{3000}]*[〕)][^\s\x{3000}，。；、]{0,20}?号"
FIELDS = f"""contents AS (SELECT page_id, source, url, html, CASE WHEN source = 'nmpa' AND length({ZOOM}) >= 20 THEN {ZOOM}
 WHEN source = 'nhsa' AND length({MARKED}) >= 10 THEN {MARKED} WHEN source = 'nhc' AND length({BOX}) >= 20 THEN {BOX} ELSE {clean('html')} END AS content
 FROM v_document_pages),
records AS (SELECT page_id, source, url, html, content,
 CASE source WHEN 'nmpa' THEN concat(CASE WHEN page_id % 2 = 0 THEN '标题 ' ELSE '页 ' END, {N})
  WHEN 'nhsa' THEN concat(CASE WHEN page_id % 2 = 0 THEN '字段 ' ELSE '标题 ' END, {N})
  ELSE concat(CASE WHEN page_id % 2 = 0 THEN '元 ' ELSE '框 ' END, {N}) END AS title,
 CASE source WHEN 'nmpa' THEN concat(CAST(2020 + page_id % 5 AS STRING), '-', lpad(CAST(1 + page_id % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0'))
  ELSE CAST(DATE '2024-01-01' + CAST(page_id % 730 AS INT) AS STRING) END AS publish_date,
 CASE WHEN regexp_matches(content, '{NUMBER}') THEN {strip(f"regexp_extract(content, '{NUMBER}')")}
  WHEN source = 'nhsa' AND page_id % 5 = 0 THEN '引〔2024〕1号' ELSE '' END AS doc_number,
 CASE source WHEN 'nmpa' THEN '' WHEN 'nhsa' THEN concat(regexp_extract(url, 'src[0-9]*', 0), ' 局') ELSE regexp_extract(url, 'src[0-9]*', 0) END AS issuing_authority,
 concat({HOST}, '/art/att/', {N}, '.pdf ', {HOST}, '/d/downfile.jsp?a=1&b=', {N}) AS attachments,
 concat({HOST}, '/img/', CAST(page_id % 7 AS STRING), '.png https://cdn.example.org/', {N}, '.gif') AS images
 FROM contents)"""


def records(t: Tables):
    return details.parse_documents(t.view("v_document_pages"), source_table(t.spark))


def joined(name: str):
    return F.array_join(F.transform(name, lambda a: a["url"]), " ").alias(name)


for _name, _columns in {
    "document_titles": "title",
    "document_dates": "publish_date",
    "document_content": "content",
    "document_number_fields": "doc_number",
    "document_authorities": "issuing_authority",
    "document_attachments": "attachments",
    "document_images": "images",
}.items():

    @query(_name, f"WITH {FIELDS} SELECT source, url, {_columns} FROM records")
    def _(t: Tables, column: str = _columns):
        value = joined(column) if column in ("attachments", "images") else F.col(column)
        return records(t).select("source", "url", value)


@query(
    "document_records",
    f"""WITH {FIELDS} SELECT source, url, title, doc_number, publish_date, '' AS implement_date, content, issuing_authority,
    attachments, images, md5(html) AS raw FROM records""",
)
def _(t: Tables):
    return records(t).select(
        "source", "url", "title", "doc_number", "publish_date", "implement_date", "content", "issuing_authority",
        joined("attachments"), joined("images"), F.md5(F.col("raw_html").cast("binary")).alias("raw"),
    )


@query("document_records_one_parser", f"WITH {FIELDS} SELECT url, CASE WHEN source = 'nhsa' AND page_id % 2 = 0 OR source = 'nhc' THEN concat('页 ', {N}) ELSE title END AS title FROM records")
def _(t: Tables):
    """All pages read with the basic rules, without a registry."""
    return details.parse_documents_as(t.view("v_document_pages"), "generic").select("url", "title")


# ---------------------------------------------------------------- links by URL

SITE_ITEMS = f"""{ITEMS}, site_items AS (SELECT page_id, pos, source, title, date,
 replace(url, 'https://www.example.org', concat('https://www.', source, '.example.org')) AS url FROM items)"""


def site_items(t: Tables):
    base = F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.org/col/index.html"))
    return listing.list_items(t.view("v_list_pages").withColumn("base", base))


def site_sources(t: Tables):
    return t.view("v_sources")


LINKED = f"""WITH {SITE_ITEMS}, {FIELDS}
SELECT i.page_id, i.pos, i.source, CASE WHEN r.page_id % 10 = 0 THEN i.title ELSE r.title END AS title, i.url AS source_url, r.doc_number,
 CASE WHEN r.issuing_authority = '' THEN concat('机构 ', i.source) ELSE r.issuing_authority END AS issuing_authority,
 CASE WHEN r.page_id % 10 = 0 THEN i.date ELSE r.publish_date END AS publish_date, length(r.content) AS n
 FROM site_items i JOIN records r ON i.url = r.url"""


@query("link_by_url", LINKED)
def _(t: Tables):
    """Every tenth record has neither title nor date, so the item's are taken."""
    tenth = F.regexp_extract("url", "([0-9]+)[.]html$", 1).cast("bigint") % 10 == 0
    found = records(t).drop("source")
    blank = {c: F.when(tenth, F.lit("")).otherwise(F.col(c)) for c in ("title", "publish_date")}
    linked = linkage.link_by_url(site_items(t), found.withColumns(blank), site_sources(t))
    return linked.select(
        "page_id", "pos", "source", "title", "source_url", "doc_number", "issuing_authority", "publish_date",
        F.length("content").alias("n"),
    )


@query("unread_items", f"WITH {SITE_ITEMS} SELECT page_id, pos, url FROM site_items WHERE url NOT IN (SELECT url FROM v_document_pages)")
def _(t: Tables):
    return linkage.unread_items(site_items(t), t.view("v_document_pages").select("url")).select("page_id", "pos", "url")


# ---------------------------------------------------------------- links by title

FIRST_LINE = "trim(split_part(text, chr(10), 1))"
TITLE_DOCS = f"""SELECT doc_id AS page_id, source, concat('https://d.example.org/', CAST(doc_id AS STRING)) AS url,
 CASE WHEN doc_id % 3 = 0 THEN concat('关于 转发 ', {FIRST_LINE}, ' 全文 的通知') ELSE {FIRST_LINE} END AS title,
 '2024-05-05' AS publish_date, concat(source, '号', CAST(doc_id AS STRING)) AS doc_number, CASE WHEN doc_id % 2 = 0 THEN '' ELSE concat('局 ', CAST(doc_id AS STRING)) END AS issuing_authority, text AS content
 FROM documents"""
TITLE_ITEMS = f"""SELECT doc_id AS page_id, 0 AS pos, source, concat('https://i.example.org/', CAST(doc_id AS STRING)) AS url,
 CASE WHEN doc_id % 3 = 2 THEN {FIRST_LINE} ELSE concat('转发 ', {FIRST_LINE}, ' 全文') END AS title, '2024-01-01' AS date FROM documents"""
MATCHED = f"""t_items AS ({TITLE_ITEMS}), t_docs AS ({TITLE_DOCS}),
pairs AS (SELECT d.page_id AS d_id, d.url AS d_url, d.source, i.page_id AS item_page_id, i.url AS item_url, i.title AS item_title,
  row_number() OVER (PARTITION BY d.page_id ORDER BY i.page_id, i.pos) AS n
 FROM t_docs d JOIN t_items i ON d.source = i.source AND (contains({strip('i.title')}, {strip('d.title')}) OR contains({strip('d.title')}, {strip('i.title')}))
 WHERE {strip('d.title')} <> ''),
firsts AS (SELECT * FROM pairs WHERE n = 1),
chosen AS (SELECT * FROM (SELECT f.*, row_number() OVER (PARTITION BY f.source, f.item_url ORDER BY f.d_id) AS k FROM firsts f) x WHERE k = 1)"""


def title_items(t: Tables):
    return t.sql(TITLE_ITEMS, parse=True)


def title_documents(t: Tables):
    attachments = F.array(F.struct(F.concat("url", F.lit(".pdf")).alias("url")))
    return t.sql(TITLE_DOCS, parse=True).withColumn("attachments", attachments)


@query("match_titles", f"WITH {MATCHED} SELECT d_url AS url, source, item_page_id, item_url FROM firsts")
def _(t: Tables):
    return linkage.match_titles(title_items(t), title_documents(t)).select("url", "source", "item_page_id", "item_url")


@query(
    "link_by_title",
    f"""WITH {MATCHED}, lead AS (SELECT source, min(page_id) AS page_id FROM t_docs GROUP BY source)
    SELECT i.page_id, i.url AS source_url, coalesce(d.doc_number, '') AS doc_number, coalesce(length(d.content), 0) AS n,
     CASE WHEN a.issuing_authority <> '' THEN a.issuing_authority ELSE concat('机构 ', i.source) END AS issuing_authority,
     CASE WHEN d.url IS NULL THEN '' ELSE concat(d.url, '.pdf') END AS attachments
    FROM t_items i LEFT JOIN chosen c ON c.source = i.source AND c.item_url = i.url LEFT JOIN t_docs d ON d.page_id = c.d_id
    LEFT JOIN lead l ON l.source = i.source LEFT JOIN t_docs a ON a.page_id = l.page_id""",
)
def _(t: Tables):
    linked = linkage.link_by_title(title_items(t), title_documents(t), site_sources(t))
    return linked.select(
        "page_id", "source_url", "doc_number", F.length("content").alias("n"), "issuing_authority", joined("attachments")
    )


@query(
    "build_report",
    f"""WITH {MATCHED}, lead AS (SELECT source, min(page_id) AS page_id FROM t_docs GROUP BY source),
    listed AS (SELECT source, count(*) AS list_items FROM t_items GROUP BY source),
    registered AS (SELECT id, name FROM v_sources UNION ALL SELECT concat('none_', n_name), concat('机构 none_', n_name) FROM nation)
    SELECT l.id AS source, coalesce(c.list_items, 0) AS list_items, coalesce(d.title, '') AS detail_title, coalesce(d.doc_number, '') AS detail_doc_number,
     coalesce(length(d.content), 0) AS detail_content_len, CASE WHEN d.issuing_authority <> '' THEN d.issuing_authority ELSE l.name END AS detail_authority,
     CASE WHEN d.url IS NULL THEN 0 ELSE 1 END AS attachments, f.item_title AS matched_item
    FROM registered l LEFT JOIN listed c ON c.source = l.id LEFT JOIN lead ON lead.source = l.id LEFT JOIN t_docs d ON d.page_id = lead.page_id LEFT JOIN firsts f ON f.d_id = d.page_id""",
)
def _(t: Tables):
    """Sources named after nations have neither items nor documents."""
    idle = t.table("nation").selectExpr("concat('none_', n_name) AS id", "concat('机构 none_', n_name) AS name")
    sources = site_sources(t).select("id", "name").unionByName(idle)
    report = offline_build.build_summary(title_items(t), title_documents(t), sources)
    return report.select(
        "source", "list_items", "detail_title", "detail_doc_number", "detail_content_len", "detail_authority",
        "attachments", "matched_item",
    )


# ---------------------------------------------------------------- enrichment

# Every policy with its whole content, and once more with nothing but its number and office.
ENRICHED = """SELECT id, id AS k, source_url, content, concat('https://a.example.org/', CAST(id AS STRING)) AS stem FROM v_policies
 UNION ALL SELECT id + 1000000000, id, concat(source_url, '#short'), concat(doc_number, ' ', issuing_authority), concat('https://a.example.org/', CAST(id AS STRING)) FROM v_policies"""


@query(
    "enrich_content",
    f"""WITH p AS ({ENRICHED}),
    docs AS (SELECT id, k, content, CASE WHEN length(content) >= 100 THEN content ELSE
      CASE WHEN k % 3 <> 0 OR (k % 2 = 0 AND k % 7 < 3) THEN {strip("concat(content, CASE WHEN k % 3 <> 0 THEN concat(chr(10), '[附件] 附 ', CAST(k AS STRING)) ELSE '' END, CASE WHEN k % 2 = 0 AND k % 7 < 3 THEN concat(chr(10), '[附件] W', CAST(k AS STRING)) ELSE '' END)")}
      ELSE content END END AS c FROM p)
    SELECT id, CASE WHEN length(content) < 100 AND length(c) < 100 AND k % 5 <> 0 THEN {strip("concat(c, chr(10), '[图片OCR] 图 ', CAST(k AS STRING))")} ELSE c END AS content FROM docs""",
)
def _(t: Tables):
    """A PDF always counts, a Word file only with a local file; the first image has no text in the table."""
    policies = t.sql(cte(ENRICHED)).selectExpr(
        "id",
        "source_url",
        "content",
        """array(named_struct('url', concat(stem, '.pdf'), 'file', ''),
           named_struct('url', concat(stem, '.docx'), 'file', if(k % 7 < 3, 'f', '')),
           named_struct('url', concat(stem, '.xls'), 'file', 'f')) AS attachments""",
        "array(named_struct('url', concat(stem, '.none.png')), named_struct('url', concat(stem, '.png'))) AS images",
    )
    return enrichment.enrich_content(policies, t.view("v_attachment_text")).select("id", "content")


@query(
    "prepare_policies",
    f"""SELECT id, CASE WHEN contains(title, '废止') OR contains(title, '失效') THEN '废止' WHEN publish_date > DATE '{AS_OF}' THEN '未生效' ELSE '有效' END AS validity_status,
    regexp_replace(regexp_replace(content, '(^|[^0-9])[0-9]{{17}}[0-9Xx]($|[^0-9])', '\\1[身份证号已脱敏]\\2', 'g'),
    '(^|[^0-9])1[3-9][0-9]{{9}}($|[^0-9])', '\\1[手机号已脱敏]\\2', 'g') AS content FROM v_policies""",
)
def _(t: Tables):
    return enrichment.prepare_policies(t.view("v_policies", parse=True), AS_OF).select("id", "validity_status", "content")
