"""The crawl ingest as one job over tables of pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.functions.dates import parse_date
from edictum.operators.details import parse_documents
from edictum.operators.enrichment import enrich_content, prepare_policies
from edictum.operators.feed import merge_feed
from edictum.operators.linkage import link_by_url
from edictum.operators.listing import first_items, item_order, parse_list_pages, recent_items
from edictum.operators.requests import without_blocked_runs
from edictum.operators.robots import allowed_only
from edictum.operators.upsert import ROW, assign_ids, run_log, upsert, with_rows
from edictum.session import stage


@dataclass
class Ingest:
    """What a run leaves behind. All lazy; ``batch`` is staged."""

    batch: DataFrame
    policies: DataFrame
    feed: DataFrame
    log: DataFrame


def crawl_batch(
    list_pages: DataFrame,
    document_pages: DataFrame,
    sources: DataFrame,
    as_of,
    days: int = 7,
    limit: int | None = 50,
    robots: DataFrame | None = None,
    requests: DataFrame | None = None,
    attachment_text: DataFrame | None = None,
    scrub: bool = True,
    **list_options,
) -> DataFrame:
    """Policy rows of crawl runs, ready to merge, with ``seq`` and, where pages carry it, ``run_id``.

    An item is linked to the page its own run read of that URL, the one with the largest page_id if
    there are several, and ``limit`` holds for each source of each run. Pages without ``run_id`` are
    one run; ``limit=None`` takes all items. Runs that met a block leave nothing; list pages and items that robots rules deny are left out.
    All that is decided on thin rows, and the items are staged, so list pages are parsed once. A
    raw document page moves at most once, to meet the pages that are wanted, and is parsed once.
    """
    sources = stage(sources)
    runs = [c for c in ("run_id",) if c in list_pages.columns and c in document_pages.columns]
    if requests is not None and not runs:
        raise ValueError("a request log goes with pages that carry run_id")
    if runs:
        run = F.coalesce("run_id", F.lit(""))
        list_pages, document_pages = list_pages.withColumn("run_id", run), document_pages.withColumn("run_id", run)
    lists = list_pages.withColumnRenamed("url", "page_url")
    checked = ["page_url"] if robots is not None else []
    items = recent_items(parse_list_pages(lists, sources, keep=(*runs, *checked), **list_options), days, as_of)
    if robots is not None:
        items = stage(items)  # checks may read them more than once
    if requests is not None:
        items = without_blocked_runs(items, requests)
    if robots is not None:
        items = allowed_only(allowed_only(items, robots, url="page_url"), robots)
    recent = items.drop(*checked)
    items = stage(recent if limit is None else first_items(recent, limit, groups=(*runs, "source")))

    on = [*runs, "url"]
    saved = document_pages.select(*on, "page_id").join(items.select(*on).distinct(), on, "left_semi")
    wanted = saved.groupBy(*on).agg(F.max("page_id").alias("page_id"))
    pages = document_pages.join(wanted, [*on, "page_id"], "left_semi")
    documents = parse_documents(pages, sources, keep=tuple(runs)).drop("source")
    linked = link_by_url(items, documents, sources, runs)
    batch = linked.select("*", item_order().alias("seq"))
    if attachment_text is not None:
        batch = enrich_content(stage(batch), attachment_text, key="seq")
    return prepare_policies(batch, as_of, scrub)


def table_columns(batch: DataFrame) -> DataFrame:
    """A batch in the types of the policy table. Raw pages go to a table of their own."""
    files = F.transform(
        "attachments", lambda a: F.struct(a["url"].alias("url"), F.lit(None).cast("string").alias("file"))
    )
    return batch.select(
        "seq",
        "source_url",
        "title",
        "doc_number",
        "issuing_authority",
        parse_date(F.col("publish_date")).alias("publish_date"),
        parse_date(F.col("implement_date")).alias("implement_date"),
        "validity_status",
        "content",
        files.alias("attachment_links"),
        F.array().cast("array<string>").alias("tags"),
    )


def raw_pages(batch: DataFrame) -> DataFrame:
    """Raw pages by URL, kept apart from the table that is searched."""
    return batch.select("source_url", "raw_html")


def ingest(
    batch: DataFrame,
    stored: DataFrame,
    existing_feed: DataFrame,
    task_name: str,
    now: Column,
    update_cols: tuple[str, ...] | None = None,
) -> Ingest:
    """Merge a batch into the policy table and the feed, with its run-log row.

    The batch is staged once: both merges, the statistics and the log read it, and page extraction
    must not run again for each.
    """
    batch = with_rows(table_columns(batch))
    merged = upsert(stored, batch, now, update_cols=update_cols)
    return Ingest(
        batch=batch.drop(ROW),
        policies=assign_ids(merged, stored),
        feed=merge_feed(existing_feed, batch, now),
        log=run_log(batch, stored, task_name, now, now),
    )
