"""Whole jobs: the crawl ingest and the offline build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import AS_OF, Tables, query
from catalog.documents import FIELDS, SITE_ITEMS
from catalog.lists import ITEMS
from catalog.merge import now, text
from catalog.sqltext import strip
from catalog.views import cte
from edictum.operators import feed
from edictum.operators.registry import source_table, with_profile
from edictum.plans import ingest as crawl
from edictum.plans import offline_build
from edictum.schemas import FEED, FEED_COLUMNS
from edictum.sources.tables import empty

SCRUBBED = """regexp_replace(regexp_replace(r.content, '(^|[^0-9])[0-9]{17}[0-9Xx]($|[^0-9])', '\\1[身份证号已脱敏]\\2', 'g'),
 '(^|[^0-9])1[3-9][0-9]{9}($|[^0-9])', '\\1[手机号已脱敏]\\2', 'g')"""
DAYS = 300


def site_registry(t: Tables) -> DataFrame:
    """The listing sites of v_sources next to the national sources."""
    sites = with_profile(t.view("v_sources"), "generic").selectExpr(
        "id", "name", "'' AS area", "'' AS base", "'' AS portal_url", "list_url", "'generic' AS parser",
        "array('/art/', '/doc/') AS keep_paths", "CAST(NULL AS STRING) AS item_url_re", "enabled",
        "title_rules", "content_rules", "doc_number_rules", "authority_rules", "date_patterns",
    )
    return source_table(t.spark).unionByName(sites)


def stored_policies(t: Tables) -> DataFrame:
    stored = t.view("v_policies").where("id % 4 <> 0")
    return stored.select(
        "id", "title", "doc_number", "issuing_authority", "publish_date", F.lit(None).cast("date").alias("implement_date"),
        "validity_status", "source_url", "content",
        F.from_json(F.lit("[]"), "array<struct<url:string,file:string>>").alias("attachment_links"),
        F.from_json("tags", "array<string>").alias("tags"), F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("created_at").cast("timestamp").alias("updated_at"),
    )


def crawl_batch(t: Tables) -> DataFrame:
    base = F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.org/col/index.html"))
    list_pages = t.view("v_list_pages").withColumn("base", base)
    return crawl.crawl_batch(
        list_pages, t.view("v_document_pages"), site_registry(t), AS_OF, days=DAYS, limit=None
    )


CRAWLED = f"""WITH {SITE_ITEMS}, {FIELDS}, batch AS (SELECT i.url AS source_url, r.title, r.doc_number,
 CASE WHEN r.issuing_authority = '' THEN concat('机构 ', i.source) ELSE r.issuing_authority END AS issuing_authority, r.publish_date,
 CASE WHEN CAST(r.publish_date AS DATE) > DATE '{AS_OF}' THEN '未生效' ELSE '有效' END AS validity_status, {SCRUBBED} AS content
 FROM site_items i JOIN records r ON i.url = r.url WHERE DATE '{AS_OF}' - CAST(i.date AS DATE) <= {DAYS}),
stored AS (SELECT * FROM v_policies WHERE id % 4 <> 0)"""


@query("crawl_batch", f"{CRAWLED} SELECT source_url, title, doc_number, issuing_authority, publish_date, validity_status, md5(content) AS content FROM batch")
def _(t: Tables):
    batch = crawl_batch(t)
    return batch.select(
        "source_url", "title", "doc_number", "issuing_authority", "publish_date", "validity_status", F.md5("content").alias("content")
    )


# ---------------------------------------------------------------- a crawl with all its inputs

RUN = "CASE WHEN page_id % 10 = 9 THEN 'x' WHEN page_id % 10 = 8 THEN 'b' ELSE 'a' END"
AGAIN = "page_id % 10 < 8 AND page_id % 3 = 0"
# Run a reads every second page twice; run b lists and reads some pages of run a again, in another wording.
LISTS_OF_RUNS = f"""WITH l AS (SELECT page_id, source, concat('https://www.', source, '.example.org/col/index.html') AS base, html FROM v_list_pages)
SELECT page_id, source, base AS url, base, html, {RUN} AS run_id FROM l UNION ALL SELECT page_id + 3000000000, source, base, base, html, 'b' FROM l WHERE {AGAIN}"""
PAGES_OF_RUNS = f"""SELECT page_id, source, url, html, {RUN} AS run_id FROM v_document_pages
 UNION ALL SELECT page_id + 1000000000, source, url, replace(html, '标题 ', '再题 '), {RUN} FROM v_document_pages WHERE page_id % 2 = 0
 UNION ALL SELECT page_id + 2000000000, source, url, replace(html, '标题 ', '外题 '), 'b' FROM v_document_pages WHERE {AGAIN}"""
REQUESTS_OF_RUNS = """SELECT CASE WHEN event_id % 10 = 9 THEN 'x' WHEN event_id % 10 = 8 THEN 'b' ELSE 'a' END AS run_id, event_id AS seq,
 CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 10 = 9 THEN 403 ELSE 500 END AS status FROM events"""
ROBOTS_OF_SITES = """SELECT concat('www.', id, '.example.org') AS host, CASE CAST(substr(id, 4) AS INT) % 4
 WHEN 0 THEN concat('User-agent: *', chr(10), 'Disallow: /doc/', chr(10)) WHEN 1 THEN concat('User-agent: *', chr(10), 'Disallow: /col/', chr(10))
 ELSE concat('# open', chr(10), 'User-agent: *', chr(10), 'Allow: /', chr(10)) END AS body FROM v_sources WHERE CAST(substr(id, 4) AS INT) % 4 <> 3"""
FILES_OF_SITES = """SELECT concat('https://www.', source, '.example.org/art/att/', CAST(doc_id AS STRING), '.pdf') AS url, 'doc' AS kind, concat('  附 ', CAST(doc_id AS STRING), ' ') AS text
 FROM documents WHERE doc_id % 3 <> 0
 UNION ALL SELECT concat('https://cdn.example.org/', CAST(doc_id AS STRING), '.gif'), 'image', concat('图 ', CAST(doc_id AS STRING)) FROM documents WHERE doc_id % 2 = 0"""
WITH_FILE = strip("concat(r.content, chr(10), '[附件] 附 ', CAST(r.id AS STRING))")
WITH_IMAGE = strip("concat(r.with_file, chr(10), '[图片OCR] 图 ', CAST(r.id AS STRING))")


FULL = f"""WITH {SITE_ITEMS}, {FIELDS}, run_items AS (SELECT *, {RUN} AS run_id FROM site_items UNION ALL
     SELECT page_id + 3000000000, pos, source, title, date, url, 'b' FROM site_items WHERE {AGAIN}),
    allowed AS (SELECT *, row_number() OVER (PARTITION BY run_id, source ORDER BY page_id, pos) AS n FROM run_items
     WHERE run_id NOT IN (SELECT run_id FROM ({REQUESTS_OF_RUNS}) q WHERE status = 403) AND DATE '{AS_OF}' - CAST(date AS DATE) <= {DAYS}
     AND CAST(substr(source, 4) AS INT) % 4 <> 1 AND NOT (CAST(substr(source, 4) AS INT) % 4 = 0 AND contains(url, '/doc/'))),
    reads AS (SELECT *, page_id AS id, {RUN} AS run_id, CASE WHEN page_id % 2 = 0 THEN '再题 ' ELSE '标题 ' END AS wording FROM records
     UNION ALL SELECT *, page_id, 'b', '外题 ' FROM records WHERE {AGAIN}),
    worded AS (SELECT run_id, id, url, replace(title, '标题 ', wording) AS title, doc_number, issuing_authority, publish_date, replace(content, '标题 ', wording) AS content FROM reads),
    filed AS (SELECT *, CASE WHEN length(content) < 100 AND id % 3 <> 0 THEN {WITH_FILE} ELSE content END AS with_file FROM worded r),
    imaged AS (SELECT * REPLACE (CASE WHEN length(content) < 100 AND length(with_file) < 100 AND id % 2 = 0 THEN {WITH_IMAGE} ELSE with_file END AS content) FROM filed r),
    batch AS (SELECT i.run_id, CAST(i.page_id AS HUGEINT) * 2147483648 + i.pos AS seq, i.url AS source_url, r.title, r.doc_number, r.publish_date,
     CASE WHEN r.issuing_authority = '' THEN concat('机构 ', i.source) ELSE r.issuing_authority END AS issuing_authority,
     CASE WHEN CAST(r.publish_date AS DATE) > DATE '{AS_OF}' THEN '未生效' ELSE '有效' END AS validity_status, {SCRUBBED} AS content
     FROM allowed i JOIN imaged r ON i.run_id = r.run_id AND i.url = r.url WHERE i.n <= 50),
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq DESC) AS n, min(seq) OVER (PARTITION BY source_url) AS first_seq FROM batch) x WHERE n = 1),
    stored AS (SELECT * FROM v_policies WHERE id % 4 <> 0)"""


def full_batch(t: Tables) -> DataFrame:
    """Three runs, one of them blocked, with robots files, attachment text and the default limit."""
    return crawl.crawl_batch(
        t.sql(cte(LISTS_OF_RUNS), parse=True), t.sql(cte(PAGES_OF_RUNS), parse=True), site_registry(t), AS_OF, days=DAYS,
        robots=t.sql(cte(ROBOTS_OF_SITES)), requests=t.sql(REQUESTS_OF_RUNS), attachment_text=t.sql(FILES_OF_SITES),
    )


def crawl_ingest(t: Tables) -> crawl.Ingest:
    return crawl.ingest(full_batch(t), stored_policies(t), empty(t.spark, FEED + ", pos bigint"), "crawl", now())


@query(
    "crawl_batch_full",
    f"{FULL} SELECT run_id, CAST(seq AS STRING) AS seq, source_url, title, doc_number, publish_date, issuing_authority, validity_status, md5(content) AS content FROM batch",
)
def _(t: Tables):
    return full_batch(t).select(
        "run_id", F.col("seq").cast("string").alias("seq"), "source_url", "title", "doc_number", "publish_date",
        "issuing_authority", "validity_status", F.md5("content").alias("content"),
    )


@query(
    "crawl_policies",
    f"""{FULL} SELECT coalesce(s.id, (SELECT max(id) FROM stored) + row_number() OVER (PARTITION BY s.id IS NULL ORDER BY b.first_seq)) AS id,
    coalesce(b.source_url, s.source_url) AS source_url, coalesce(b.title, s.title) AS title, coalesce(b.doc_number, s.doc_number) AS doc_number,
    coalesce(b.issuing_authority, s.issuing_authority) AS issuing_authority, CASE WHEN b.source_url IS NULL THEN CAST(s.publish_date AS STRING) ELSE b.publish_date END AS publish_date,
    coalesce(b.validity_status, s.validity_status) AS validity_status, md5(coalesce(b.content, s.content)) AS content, CASE WHEN b.source_url IS NULL THEN s.tags ELSE '[]' END AS tags,
    CASE WHEN s.id IS NULL THEN '2025-01-01 00:00:00' ELSE CAST(s.created_at AS STRING) END AS created_at,
    CASE WHEN b.source_url IS NULL THEN CAST(s.created_at AS STRING) ELSE '2025-01-01 00:00:00' END AS updated_at FROM stored s FULL JOIN latest b ON s.source_url = b.source_url""",
)
def _(t: Tables):
    """The policy table after the runs, from pages, robots, requests and attachments to merged rows."""
    return crawl_ingest(t).policies.select(
        "id", "source_url", "title", "doc_number", "issuing_authority", F.col("publish_date").cast("string").alias("publish_date"),
        "validity_status", F.md5("content").alias("content"), F.to_json("tags").alias("tags"), *text("created_at", "updated_at"),
    )


@query(
    "crawl_log",
    f"""{FULL} SELECT 'crawl' AS task_name, count(*) AS total_fetched, count(DISTINCT source_url) FILTER (WHERE source_url NOT IN (SELECT source_url FROM stored)) AS new_added,
    0 AS error_count, 'SUCCESS' AS status FROM batch""",
)
def _(t: Tables):
    return crawl_ingest(t).log.select("task_name", "total_fetched", "new_added", "error_count", "status")


@query(
    "crawl_feed",
    f"""{FULL} SELECT concat('p_', substr(sha256(source_url), 1, 12)) AS id, {strip("title")} AS title, source_url AS url, publish_date, substr(content, 1, 200) AS content_preview,
    {strip("issuing_authority")} AS source_site, '2025-01-01 00:00:00' AS created_at, row_number() OVER (ORDER BY publish_date DESC, first_seq) - 1 AS pos FROM latest""",
)
def _(t: Tables):
    """The published feed after the runs."""
    return feed.positioned_feed(crawl_ingest(t).feed)


# ---------------------------------------------------------------- offline build

KIND = "CASE page_id % 3 WHEN 0 THEN 'nmpa' WHEN 1 THEN 'nhsa' ELSE 'nhc' END"
OFFLINE_DOCS = "SELECT page_id, source, url, replace(html, '标题 ', '文件 ') AS html FROM v_document_pages"
OFFLINE = f"""WITH {ITEMS}, {FIELDS}, listed AS (SELECT page_id, pos, {KIND} AS source, url, title, date FROM items),
docs AS (SELECT page_id, source, url, replace(title, '标题 ', '文件 ') AS title, doc_number, replace(content, '标题 ', '文件 ') AS content, issuing_authority, attachments FROM records),
pairs AS (SELECT d.page_id AS d_id, d.source, i.url AS item_url, row_number() OVER (PARTITION BY d.page_id ORDER BY i.page_id, i.pos) AS n
 FROM docs d JOIN listed i ON d.source = i.source AND (contains({strip('i.title')}, d.title) OR contains(d.title, {strip('i.title')}))),
chosen AS (SELECT source, item_url, min(d_id) AS d_id FROM pairs WHERE n = 1 GROUP BY 1, 2),
lead AS (SELECT source, min(page_id) AS page_id FROM docs GROUP BY source)"""

BUILT = """built AS (SELECT i.page_id, i.pos, i.url, i.title, i.date, coalesce(d.doc_number, '') AS doc_number, coalesce(d.content, '') AS content,
     CASE WHEN a.issuing_authority <> '' THEN a.issuing_authority ELSE '国家药品监督管理局' END AS issuing_authority
     FROM listed i LEFT JOIN chosen c ON c.source = i.source AND c.item_url = i.url LEFT JOIN docs d ON d.page_id = c.d_id
     JOIN lead l ON l.source = i.source JOIN docs a ON a.page_id = l.page_id)"""


def offline(t: Tables):
    pages = t.view("v_list_pages").withColumn("source", F.expr(KIND))
    sources = source_table(t.spark).withColumns(
        {"item_url_re": F.lit(None).cast("string"), "keep_paths": F.array().cast("array<string>")}
    )
    items, documents = offline_build.list_documents(pages, t.sql(cte(OFFLINE_DOCS), parse=True), sources)
    return offline_build.build_policies(items, documents, sources)


@query(
    "offline_build",
    f"""{OFFLINE} SELECT i.page_id, i.pos, i.url AS source_url, i.title, i.date AS publish_date, coalesce(d.doc_number, '') AS doc_number,
     CASE WHEN a.issuing_authority <> '' THEN a.issuing_authority ELSE '国家药品监督管理局' END AS issuing_authority,
     md5(coalesce(d.content, '')) AS content, coalesce(d.attachments, '') AS attachments
    FROM listed i LEFT JOIN chosen c ON c.source = i.source AND c.item_url = i.url LEFT JOIN docs d ON d.page_id = c.d_id
    JOIN lead l ON l.source = i.source JOIN docs a ON a.page_id = l.page_id""",
)
def _(t: Tables):
    """Saved list and document pages to policy rows, documents attached by title."""
    links = F.array_join(F.transform("attachments", lambda a: a["url"]), " ")
    return offline(t).select(
        "page_id", "pos", "source_url", "title", "publish_date", "doc_number", "issuing_authority",
        F.md5("content").alias("content"), links.alias("attachments"),
    )


def stored_listings(t: Tables) -> DataFrame:
    """Stored policies under the URLs of the saved list pages; every fourth is missing."""
    return stored_policies(t).withColumn("source_url", F.format_string("https://www.example.org/art/%d.html", "id"))


@query(
    "offline_upsert",
    f"""{OFFLINE}, {BUILT},
    kept AS (SELECT *, concat('https://www.example.org/art/', CAST(id AS STRING), '.html') AS k_url FROM v_policies WHERE id % 4 <> 0)
    SELECT coalesce(k.id, (SELECT max(id) FROM kept) + row_number() OVER (PARTITION BY k.id IS NULL ORDER BY b.page_id, b.pos)) AS id, coalesce(b.url, k.k_url) AS source_url,
     coalesce(b.title, k.title) AS title, coalesce(b.doc_number, k.doc_number) AS doc_number, coalesce(b.issuing_authority, k.issuing_authority) AS issuing_authority,
     coalesce(b.date, CAST(k.publish_date AS STRING)) AS publish_date, CASE WHEN b.url IS NULL THEN k.validity_status ELSE '有效' END AS validity_status,
     md5(coalesce(b.content, k.content)) AS content, k.id IS NULL AS added FROM built b FULL JOIN kept k ON k.k_url = b.url""",
)
def _(t: Tables):
    """The policy table after an offline build: listed rows updated or added with the next ids, others as they were."""
    after = offline_build.store_policies(offline(t), stored_listings(t), now())
    return after.select(
        "id", "source_url", "title", "doc_number", "issuing_authority", F.col("publish_date").cast("string").alias("publish_date"),
        "validity_status", F.md5("content").alias("content"), (F.col("created_at") == now()).alias("added"),
    )


@query(
    "offline_feed",
    f"""{OFFLINE}, {BUILT}, last AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id DESC, pos DESC) AS n FROM built)
    SELECT concat('p_', substr(sha256(url), 1, 12)) AS id, {strip("title")} AS title, url, date AS publish_date, substr(content, 1, 200) AS content_preview,
     {strip("issuing_authority")} AS source_site, '2025-01-01 00:00:00' AS created_at FROM last WHERE n = 1""",
)
def _(t: Tables):
    """The feed of an offline build: every listed URL once, with its document."""
    return feed.merge_feed(empty(t.spark, FEED + ", pos bigint"), offline(t), now()).select(*FEED_COLUMNS)
