"""Search over the policy table: filters, order, pages, lookups."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edictum.functions.dates import VALID, clamp
from edictum.functions.text import contains_ci, like_contains

BRIEF = ["id", "title", "doc_number", "issuing_authority", "publish_date", "validity_status", "source_url", "tags"]
MAX_PAGE, MAX_SIZE, DEFAULT_SIZE = 1_000_000, 100, 20
# Ids of a block: what a page sorts at most of a day, for each block it reaches.
BLOCK = 1 << 16


def tags_text(policies: DataFrame) -> Column:
    """Tags as JSON text, however they are stored."""
    if isinstance(policies.schema["tags"].dataType, T.ArrayType):
        return F.to_json("tags")
    return F.col("tags")


def _sides(value: str) -> tuple[Column, Column]:
    """(date column, bound): as dates where the bound is one, so that it reaches the scan; else as text."""
    day = F.col("publish_date")
    try:
        if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
            return day, F.lit(dt.date.fromisoformat(value))
    except ValueError:  # no such day in the calendar
        pass
    return day.cast("string"), F.lit(value)


def from_date(value: str) -> Column:
    day, bound = _sides(value)
    return day >= bound


def to_date(value: str) -> Column:
    """Undated policies pass an upper bound."""
    day, bound = _sides(value)
    return (day <= bound) | F.col("publish_date").isNull()


def predicates(
    policies: DataFrame,
    keyword: str = "",
    authority: str = "",
    tag: str = "",
    status: str = "",
    date_from: str = "",
    date_to: str = "",
    exact_tag: str = "",
) -> list[Column]:
    """One predicate per filter that is not blank."""
    keyword, authority, tag, status, date_from, date_to, exact_tag = (
        (v or "").strip() for v in (keyword, authority, tag, status, date_from, date_to, exact_tag)
    )
    found = []
    if keyword:
        texts = [like_contains(F.col(c), keyword) for c in ("title", "content", "doc_number")]
        found.append(reduce(Column.__or__, texts))
    if authority:
        found.append(like_contains(F.col("issuing_authority"), authority))
    if tag:
        found.append(like_contains(tags_text(policies), tag))
    if exact_tag:
        found.append(F.array_contains("tags", exact_tag))
    if status:
        found.append(F.col("validity_status") == status)
    if date_from:
        found.append(from_date(date_from))
    if date_to:
        found.append(to_date(date_to))
    return found


def search(policies: DataFrame, **filters: str) -> DataFrame:
    """Policies that pass all filters; no filter, no restriction. Lazy, all columns."""
    return reduce(DataFrame.where, predicates(policies, **filters), policies)


def viewer_search(
    policies: DataFrame,
    keyword: str = "",
    authority: str = "",
    status: str = "",
    date_from: str = "",
    date_to: str = "",
) -> DataFrame:
    """The page viewer's search: plain containment, exact authority, a blank status is in force."""
    found = policies
    if keyword.strip():
        blob = F.concat(
            F.coalesce("title", F.lit("")), F.lit(" "),
            F.coalesce("doc_number", F.lit("")), F.lit(" "),
            F.coalesce("content", F.lit("")),
        )
        found = found.where(contains_ci(blob, keyword.strip()))
    if authority:
        found = found.where(F.col("issuing_authority") == authority)
    if status:
        current = F.coalesce(F.nullif("validity_status", F.lit("")), F.lit(VALID))
        found = found.where(current == status)
    if date_from:
        found = found.where(from_date(date_from))
    if date_to:
        found = found.where(to_date(date_to))
    return found


def newest_first(policies: DataFrame) -> DataFrame:
    """Newest first, equal dates by id descending, undated last."""
    return policies.orderBy(F.desc_nulls_last("publish_date"), F.desc("id"))


def brief(policies: DataFrame) -> DataFrame:
    """The columns of a result list; content and raw text are not read."""
    return policies.select(*BRIEF)


def total(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("total"))


def rank_directory(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """(publish_date, block, rows): how many rows each day and each range of ids holds.

    Kept with a table, it answers at which place of the order a row stands without reading the table.
    """
    return found.groupBy("publish_date", F.floor(F.col("id") / F.lit(block)).alias("block")).agg(F.count(F.lit(1)).alias("rows"))


def page(
    found: DataFrame,
    page: int | str = 1,
    size: int | str = DEFAULT_SIZE,
    directory: DataFrame | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """One page of results, in order; empty past the end. Every depth goes the same way.

    The directory tells which days a page falls in, and which ranges of ids of those: no more than it
    has rows, each of at most ``block`` rows, and only these are sorted. ``directory`` is that of
    ``found`` where one is kept; else it is counted, from two thin columns next to those filtered by.
    """
    number = clamp(page, 1, 1, MAX_PAGE)
    rows = clamp(size, DEFAULT_SIZE, 1, MAX_SIZE)
    skip = (number - 1) * rows
    earlier = (Window.unboundedPreceding, -1)
    in_page = (F.col("before") < skip + rows) & (F.col("before") + F.col("rows") > skip)

    def reached(counts: DataFrame, order: Window, start: Column) -> DataFrame:
        before = F.coalesce(F.sum("rows").over(order.rowsBetween(*earlier)), F.lit(0)) + start
        return counts.withColumn("before", before).where(in_page)

    counts = rank_directory(found, block) if directory is None else directory
    days = counts.groupBy("publish_date").agg(F.sum("rows").alias("rows"))
    days = reached(days, Window.orderBy(F.desc_nulls_last("publish_date")), F.lit(0))
    days = days.select(F.col("publish_date").alias("day"), F.col("before").alias("day_before"))
    blocks = counts.join(F.broadcast(days), F.col("publish_date").eqNullSafe(F.col("day")))
    blocks = reached(blocks, Window.partitionBy("publish_date").orderBy(F.desc("block")), F.col("day_before"))
    blocks = blocks.select(F.col("publish_date").alias("day"), F.col("block").alias("wanted"), "before")
    thin = brief(found).withColumn("own", F.floor(F.col("id") / F.lit(block)))
    near = thin.join(F.broadcast(blocks), F.col("publish_date").eqNullSafe(F.col("day")) & (F.col("own") == F.col("wanted")))
    place = F.col("before") + F.row_number().over(Window.partitionBy("publish_date", "own").orderBy(F.desc("id")))
    return newest_first(near.withColumn("place", place).where(F.col("place").between(skip + 1, skip + rows)).select(*BRIEF))


def page_after(found: DataFrame, publish_date: str | None, last_id: int, size: int = DEFAULT_SIZE) -> DataFrame:
    """The page that follows a given last row, dated or not; any depth costs the same.

    A day that is not in the calendar is compared as text, as the date filters do.
    """
    undated = F.col("publish_date").isNull()
    if publish_date:
        day, bound = _sides(publish_date)
        after = (day < bound) | ((day == bound) & (F.col("id") < last_id)) | undated
    else:
        after = undated & (F.col("id") < last_id)
    return newest_first(brief(found.where(after))).limit(clamp(size, DEFAULT_SIZE, 1, MAX_SIZE))


def by_id(policies: DataFrame, policy_id: int | str) -> DataFrame:
    """Lookup by id; text that is no number finds nothing."""
    return policies.where(F.col("id") == F.lit(str(policy_id)).try_cast("bigint"))


def by_url(policies: DataFrame, url: str) -> DataFrame:
    return policies.where(F.col("source_url") == url)


def authorities(policies: DataFrame) -> DataFrame:
    """Distinct authorities that are not blank, sorted."""
    return policies.select("issuing_authority").where("issuing_authority <> ''").distinct().orderBy("issuing_authority")
