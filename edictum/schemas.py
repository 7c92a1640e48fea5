"""Table schemas."""

from __future__ import annotations

PAGES = "page_id bigint, source string, url string, base string, html string"

LIST_ITEMS = "page_id bigint, pos int, source string, url string, title string, date string"

POLICIES = """
    id bigint, title string, doc_number string, issuing_authority string, publish_date date,
    implement_date date, validity_status string, source_url string, content string,
    attachment_links array<struct<url:string,file:string>>, tags array<string>,
    created_at timestamp, updated_at timestamp
"""

CRAWLER_LOGS = """
    id bigint, task_name string, start_time timestamp, end_time timestamp, total_fetched bigint,
    new_added bigint, error_count bigint, error_details string, status string
"""

FEED = """
    id string, title string, url string, publish_date string, content_preview string,
    source_site string, created_at string
"""

FEED_COLUMNS = ["id", "title", "url", "publish_date", "content_preview", "source_site", "created_at"]

ATTACHMENT_TEXT = "url string, kind string, text string"

RULES = "array<struct<pattern:string,min_len:int,plain:boolean>>"

SOURCES = f"""
    id string, name string, area string, base string, portal_url string, list_url string,
    parser string, keep_paths array<string>, item_url_re string, enabled boolean,
    title_rules {RULES}, content_rules {RULES}, doc_number_rules {RULES}, authority_rules {RULES},
    date_patterns array<string>
"""

NAVIGATION = "map<string,array<struct<name:string,area:string,portal_url:string,system_urls:array<string>>>>"

ROBOTS = "host string, body string"

REQUEST_LOG = "run_id string, seq bigint, url string, attempt int, status int, elapsed double, ts timestamp"
