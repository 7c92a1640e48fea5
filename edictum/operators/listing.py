"""List pages to list items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edictum.functions.dates import first_valid_date, is_recent
from edictum.functions.names import fresh
from edictum.functions.text import clean_html_text, first_nonblank, trim_u
from edictum.functions.urls import resolve_url, url_path
from edictum.operators.registry import ANCHOR, LI, NOISE_TITLES, PAGE_HREF, with_keep_paths

SALTS = 64


def pages_with_source(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach the registry row. Pages stay where they are if Spark knows the registry to be small.

    A registry that comes out of a query has no known size: stage it first.
    """
    rows = sources.withColumnsRenamed({"id": "source", "base": "source_base"})
    return pages.join(rows, "source").withColumn(
        "base", first_nonblank(F.col("base"), F.col("source_base"))
    )


def unknown_sources(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Pages whose source is not registered."""
    return pages.join(sources.select(F.col("id").alias("source")), "source", "left_anti")


def list_entries(html: Column) -> Column:
    """One array element per ``<li>`` that holds a link: position, entry, href, link body, rest."""
    entries = F.transform(
        F.regexp_extract_all(html, F.lit(LI), F.lit(1)),
        lambda li, i: F.struct(
            i.alias("pos"),
            li.alias("li"),
            trim_u(F.regexp_extract(li, ANCHOR, 1)).alias("href"),
            F.regexp_extract(li, ANCHOR, 2).alias("body"),
            F.regexp_extract(li, ANCHOR, 3).alias("tail"),
            li.rlike(ANCHOR).alias("linked"),
        ),
    )
    return F.filter(entries, lambda e: e["linked"])


def is_noise(title: Column, words=NOISE_TITLES) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(title, w))


def in_directories(url: Column, keep_paths: Column) -> Column:
    """URL path under one of the directories; none named means no filter."""
    return (F.coalesce(F.size(keep_paths), F.lit(0)) <= 0) | F.exists(
        keep_paths, lambda p: F.startswith(url_path(url), p)
    )


def item_date(tail: Column, entry: Column) -> Column:
    """First valid date after the link, else first valid date of the entry, else ``''``."""
    return first_nonblank(first_valid_date(tail), first_valid_date(entry))


def list_items(
    pages: DataFrame,
    href_re: str = PAGE_HREF,
    min_title: int = 4,
    noise=NOISE_TITLES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Items of list pages: (page_id, pos, source, url, title, date).

    Reads page_id, source, base, html and, where present, keep_paths and item_url_re. Works on
    arrays within the page row and explodes only what is kept; no shuffle. ``keep`` names further
    page columns to pass through.
    """
    base = F.col("base")
    entries = F.filter(list_entries(F.col("html")), lambda e: e["href"].rlike(href_re))
    titled = F.transform(
        entries,
        lambda e: F.struct(
            e["pos"].alias("pos"),
            e["li"].alias("li"),
            e["tail"].alias("tail"),
            e["href"].alias("href"),
            clean_html_text(e["body"]).alias("title"),
        ),
    )
    wanted = F.filter(titled, lambda e: (F.length(e["title"]) >= min_title) & ~is_noise(e["title"], noise))
    items = F.transform(
        wanted,
        lambda e: F.struct(
            e["pos"].alias("pos"),
            resolve_url(base, e["href"]).alias("url"),
            e["title"].alias("title"),
            item_date(e["tail"], e["li"]).alias("date"),
        ),
    )
    if "keep_paths" in pages.columns:
        items = F.filter(items, lambda e: in_directories(e["url"], F.col("keep_paths")))
    if "item_url_re" in pages.columns:
        pattern = F.col("item_url_re")
        items = F.filter(items, lambda e: pattern.isNull() | F.regexp_like(e["url"], pattern))
    found = pages.select("page_id", "source", *keep, F.inline(items))
    return found.select("page_id", "pos", "source", "url", "title", "date", *keep)


def parse_list_pages(pages: DataFrame, sources: DataFrame, **options) -> DataFrame:
    """List items of pages, read with the rules of their source."""
    return list_items(pages_with_source(pages, with_keep_paths(sources)), **options)


def recent_items(items: DataFrame, days: int, as_of) -> DataFrame:
    return items.where(is_recent(F.col("date"), days, as_of))


def first_items(items: DataFrame, n: int = 50, groups: tuple[str, ...] = ("source",), salts: int = SALTS) -> DataFrame:
    """First ``n`` items of each source, or of each of ``groups``, in page order.

    Each group is cut to ``n`` in every task that reads items, again in each of ``salts`` shares of its
    pages, and then once more: a group with most of the items brings ``salts * n`` rows together.
    """
    seq, salt, rank = fresh(items, "seq", "salt", "rank")
    placed = items.withColumn(seq, item_order()).withColumn(salt, F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    for share in ([*groups, salt], list(groups)):
        first = F.row_number().over(Window.partitionBy(*share).orderBy(seq))
        placed = placed.withColumn(rank, first).where(F.col(rank) <= n).drop(rank)
    return placed.select(*items.columns)


def item_order() -> Column:
    """Position of an item over all pages: a decimal of 32 digits, so any page id and any entry fits."""
    page, pos = F.col("page_id").cast("decimal(20,0)"), F.col("pos").cast("decimal(10,0)")
    return page * F.lit(1 << 31).cast("decimal(10,0)") + pos


def tsv_lines(items: DataFrame) -> DataFrame:
    """date, title, url: the columns of the plain listing."""
    return items.select("date", "title", "url")
