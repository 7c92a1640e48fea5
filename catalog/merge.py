"""Merges into the policy table and the feed, run statistics, run logs, files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import Tables, query
from edictum.functions.text import preview
from edictum.operators import feed, upsert
from edictum.operators.numbering import number_rows
from edictum.session import shared_dir
from edictum.sources import feed_files, tables

NOW = "TIMESTAMP '2025-01-01 00:00:00'"

# What a batch leaves: the last accepted row of each URL and where it first appeared.
LATEST = """accepted AS (SELECT * FROM v_incoming WHERE title IS NOT NULL AND source_url IS NOT NULL),
latest AS (SELECT source_url, title, content, doc_number, seq, first_seq FROM
 (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq DESC) AS n, min(seq) OVER (PARTITION BY source_url) AS first_seq FROM accepted) x WHERE n = 1)"""


def now():
    return F.expr(NOW)


def scratch(t: Tables, name: str) -> str:
    """A new folder next to the session's checkpoints."""
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def text(*names: str):
    return [F.col(n).cast("string").alias(n) for n in names]


@query("batch_latest", f"WITH {LATEST} SELECT source_url, title, content, seq, first_seq FROM latest")
def _(t: Tables):
    batch = upsert.accepted(t.view("v_incoming"))
    return upsert.latest_per_key(batch).select("source_url", "title", "content", "seq", "first_seq")


MERGED = f"""WITH {LATEST}, merged AS (SELECT coalesce(l.source_url, s.source_url) AS source_url, s.id, coalesce(l.title, s.title) AS title,
 coalesce(l.content, s.content) AS content, coalesce(l.doc_number, s.doc_number) AS all_number,
 CASE WHEN s.source_url IS NULL THEN l.doc_number ELSE s.doc_number END AS kept_number,
 CAST(coalesce(CAST(s.created_at AS STRING), '2025-01-01 00:00:00') AS STRING) AS created_at,
 CASE WHEN l.source_url IS NULL THEN CAST(s.updated_at AS STRING) ELSE '2025-01-01 00:00:00' END AS updated_at, s.source_url IS NULL AS is_new, l.first_seq
 FROM v_stored s FULL JOIN latest l ON s.source_url = l.source_url)"""


@query("upsert_all_fields", f"{MERGED} SELECT source_url, id, title, content, all_number AS doc_number, created_at, updated_at, is_new FROM merged")
def _(t: Tables):
    merged = upsert.upsert(t.view("v_stored"), t.view("v_incoming"), now())
    return merged.select("source_url", "id", "title", "content", "doc_number", *text("created_at", "updated_at"), "is_new")


@query("upsert_title_and_content", f"{MERGED} SELECT source_url, id, title, content, kept_number AS doc_number, created_at, is_new FROM merged")
def _(t: Tables):
    merged = upsert.upsert(t.view("v_stored"), t.view("v_incoming"), now(), update_cols=("title", "content"))
    return merged.select("source_url", "id", "title", "content", "doc_number", *text("created_at"), "is_new")


@query(
    "upsert_with_ids",
    f"""{MERGED} SELECT source_url, title, CASE WHEN is_new THEN (SELECT max(id) FROM v_stored) +
    CAST(row_number() OVER (PARTITION BY is_new ORDER BY first_seq) AS BIGINT) ELSE id END AS id FROM merged""",
)
def _(t: Tables):
    stored = t.view("v_stored")
    merged = upsert.upsert(stored, t.view("v_incoming"), now())
    return upsert.assign_ids(merged, stored).select("source_url", "title", "id")


@query("upsert_twice", "WITH once AS (SELECT count(DISTINCT source_url) AS n FROM (SELECT source_url FROM v_stored UNION ALL SELECT source_url FROM v_incoming WHERE title IS NOT NULL) x) SELECT n AS policies, 0 AS new_added FROM once")
def _(t: Tables):
    """The same batch again adds nothing."""
    stored, batch = t.view("v_stored"), t.view("v_incoming")
    once = upsert.assign_ids(upsert.upsert(stored, batch, now()), stored)
    again = upsert.upsert(once, batch, now())
    return again.agg(F.count(F.lit(1)).alias("policies"), F.count_if("is_new").alias("new_added"))


@query("known_urls", "SELECT DISTINCT source_url FROM v_incoming WHERE source_url IN (SELECT source_url FROM v_stored)")
def _(t: Tables):
    return upsert.known(t.view("v_incoming"), t.view("v_stored")).select("source_url").distinct()


@query("new_urls", "SELECT DISTINCT source_url FROM v_incoming WHERE source_url NOT IN (SELECT source_url FROM v_stored)")
def _(t: Tables):
    return upsert.unknown(t.view("v_incoming"), t.view("v_stored")).select("source_url").distinct()


@query("rejected_rows", "SELECT seq, source_url, 'NOT NULL constraint failed: policies.title' AS error FROM v_incoming WHERE title IS NULL")
def _(t: Tables):
    return upsert.rejected(t.view("v_incoming")).select("seq", "source_url", "error")


@query("accepted_rows", "SELECT seq, source_url FROM v_incoming WHERE title IS NOT NULL")
def _(t: Tables):
    return upsert.accepted(t.view("v_incoming")).select("seq", "source_url")


STATS = f"""WITH {LATEST}, s AS (SELECT (SELECT count(*) FROM v_incoming) AS total, (SELECT count(*) FROM v_incoming WHERE title IS NULL) AS errors,
 (SELECT count(*) FROM latest WHERE source_url NOT IN (SELECT source_url FROM v_stored)) AS new_added)"""


@query("run_statistics", f"{STATS} SELECT total, new_added, errors, CASE WHEN errors = 0 THEN 'SUCCESS' WHEN new_added > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS status FROM s")
def _(t: Tables):
    return upsert.run_statistics(t.view("v_incoming"), t.view("v_stored"))


DETAILS = """SELECT substr(string_agg(concat(source_url, ': NOT NULL constraint failed: policies.title'), chr(10) ORDER BY seq), 1, 4000) AS error_details
 FROM v_incoming WHERE title IS NULL"""


@query("error_details", DETAILS)
def _(t: Tables):
    return upsert.error_details(upsert.rejected(t.view("v_incoming")))


@query("run_log", f"{STATS} SELECT 'demo' AS task_name, total AS total_fetched, new_added, errors AS error_count, ({DETAILS}) AS error_details, CASE WHEN new_added > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS status FROM s")
def _(t: Tables):
    log = upsert.run_log(t.view("v_incoming"), t.view("v_stored"), "demo", now(), now())
    return log.drop("start_time", "end_time")


@query("run_log_appended", "SELECT 1 AS id, 'demo' AS task_name, count(*) AS total_fetched FROM v_incoming UNION ALL SELECT 2, 'demo', count(*) FROM v_incoming")
def _(t: Tables):
    """Tables made where missing, two runs logged, the log read back newest first."""
    root = scratch(t, "tables")
    tables.create_tables(t.spark, root)
    log = upsert.run_log(t.view("v_incoming"), t.view("v_stored"), "demo", now(), now())
    for _run in range(2):
        tables.append_log(log, f"{root}/crawler_logs")
    return upsert.last_logs(tables.read_table(t.spark, f"{root}/crawler_logs")).select("id", "task_name", "total_fetched")


@query("last_logs", "SELECT event_id AS id, event_type AS task_name FROM events ORDER BY event_id DESC LIMIT 20")
def _(t: Tables):
    return upsert.last_logs(t.table("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("task_name")))


# ---------------------------------------------------------------- the feed

FEED = """incoming AS (SELECT trim(source_url) AS url, trim(title) AS title, publish_date, substr(content, 1, 200) AS content_preview,
 trim(issuing_authority) AS source_site, '2025-01-01 00:00:00' AS created_at, seq FROM v_feed_incoming WHERE trim(source_url) <> ''),
both_sides AS (SELECT id, title, url, publish_date, content_preview, source_site, created_at, 0 AS side, pos AS ord FROM v_feed
 UNION ALL SELECT NULL, coalesce(title, ''), url, publish_date, content_preview, source_site, created_at, 1, seq FROM incoming),
last_old AS (SELECT url, id FROM (SELECT url, id, row_number() OVER (PARTITION BY url ORDER BY pos DESC) AS n FROM v_feed) x WHERE n = 1),
last_row AS (SELECT *, first_value(side) OVER w AS first_side, first_value(ord) OVER w AS first_ord, row_number() OVER (PARTITION BY url ORDER BY side DESC, ord DESC) AS n
 FROM both_sides WINDOW w AS (PARTITION BY url ORDER BY side, ord)),
merged_feed AS (SELECT CASE WHEN r.side = 0 OR o.id <> '' THEN o.id ELSE concat('p_', substr(sha256(r.url), 1, 12)) END AS id, r.title, r.url, r.publish_date, r.content_preview,
 r.source_site, r.created_at, r.first_side = 1 AS is_added, row_number() OVER (ORDER BY r.publish_date DESC, r.first_side, r.first_ord) - 1 AS pos
 FROM last_row r LEFT JOIN last_old o ON r.url = o.url WHERE r.n = 1)"""
FEED_COLS = "id, title, url, publish_date, content_preview, source_site, created_at"


def merged_feed(t: Tables):
    return feed.merge_feed(t.view("v_feed"), t.view("v_feed_incoming"), now())


@query("feed_merge", f"WITH {FEED} SELECT {FEED_COLS}, is_added FROM merged_feed")
def _(t: Tables):
    return merged_feed(t).drop("ord")


@query("feed_positions", f"WITH {FEED} SELECT url, publish_date, pos FROM merged_feed")
def _(t: Tables):
    return feed.positioned_feed(merged_feed(t), parts=8).select("url", "publish_date", "pos")


@query("feed_ids", f"WITH {FEED} SELECT url, id FROM merged_feed")
def _(t: Tables):
    return merged_feed(t).select("url", "id")


@query("feed_previews", "SELECT id, substr(content, 1, 200) AS content_preview FROM v_policies")
def _(t: Tables):
    return t.view("v_policies").select("id", preview(F.col("content")).alias("content_preview"))


@query("feed_files", f"WITH {FEED} SELECT {FEED_COLS}, pos FROM merged_feed")
def _(t: Tables):
    """Written in published order and read back."""
    path = scratch(t, "feed")
    feed_files.write_feed(merged_feed(t), path)
    return feed_files.read_feed(t.spark, path)


@query("feed_array", f"WITH {FEED} SELECT {FEED_COLS} FROM merged_feed")
def _(t: Tables):
    """Written as parts that join to one JSON array, and read back."""
    path = scratch(t, "feed-array")
    feed_files.write_feed_array(merged_feed(t), path)
    return feed_files.read_feed_array_parts(t.spark, path)


@query("feed_audit", "SELECT count(*) AS records, count(*) AS complete, count(*) - count(DISTINCT url) AS duplicate_urls, (SELECT count(*) FROM (SELECT publish_date > lag(publish_date) OVER (ORDER BY pos) AS bad FROM v_feed) x WHERE bad) AS out_of_order FROM v_feed")
def _(t: Tables):
    """Records out of order are counted in chunks; positions with gaps are numbered first."""
    dense = number_rows(t.view("v_feed"), "pos", out="place", start=0)
    return feed.feed_audit(dense.drop("pos").withColumnRenamed("place", "pos"), chunk=50)


@query("feed_sites", "SELECT source_site, count(*) AS records FROM v_feed GROUP BY 1")
def _(t: Tables):
    return feed.site_distribution(t.view("v_feed"))
