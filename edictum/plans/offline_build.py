"""Bulk build from saved pages: list pages and document pages in, policy rows and report out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.functions.dates import VALID
from edictum.operators.details import parse_documents
from edictum.operators.linkage import link_by_title, match_titles
from edictum.operators.listing import item_order, list_items, pages_with_source
from edictum.operators.stats import build_report
from edictum.operators.upsert import assign_ids, upsert, with_rows
from edictum.plans.ingest import table_columns
from edictum.session import stage


def list_documents(list_pages: DataFrame, document_pages: DataFrame, sources: DataFrame, **options):
    """Items and document records of the saved pages; documents keep source and page_id.

    Both are staged: matching, linking and the report read them again and again, and the pages
    should be parsed once.
    """
    sources = stage(sources)
    items = list_items(pages_with_source(list_pages, sources), **options)
    documents = parse_documents(document_pages, sources, keep=("page_id",))
    return stage(items), stage(documents.drop("raw_html"))


def build_policies(items: DataFrame, documents: DataFrame, sources: DataFrame) -> DataFrame:
    """Policy rows of all items, in page order, ready to merge."""
    linked = link_by_title(items, documents, sources)
    return linked.select("*", item_order().alias("seq"), F.lit("").alias("implement_date"), F.lit("").alias("raw_html"))


def store_policies(batch: DataFrame, stored: DataFrame, now: Column) -> DataFrame:
    """The policy table after an offline build: its rows, all in force, merged by URL."""
    rows = with_rows(table_columns(batch.withColumn("validity_status", F.lit(VALID))))
    return assign_ids(upsert(stored, rows, now), stored)


def build_summary(items: DataFrame, documents: DataFrame, sources: DataFrame) -> DataFrame:
    return build_report(items, documents, match_titles(items, documents), sources)
