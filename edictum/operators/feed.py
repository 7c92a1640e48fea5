"""The published feed: one record per URL, newest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edictum.functions.text import preview, trim_u
from edictum.operators.numbering import number_rows
from edictum.operators.skew import thin_side
from edictum.operators.upsert import ROW, with_rows
from edictum.schemas import FEED_COLUMNS
from edictum.session import stage

# Positions compared in one task by the order audit.
CHUNK = 1 << 20
# New records come after all stored ones when dates tie.
_NEW = 1 << 50


def feed_id(url: Column, old_id: Column) -> Column:
    """The id a URL already has, else one derived from the URL: the same on every retry."""
    return F.coalesce(
        F.nullif(old_id, F.lit("")), F.concat(F.lit("p_"), F.substring(F.sha2(url, 256), 1, 12))
    )


def feed_url() -> Column:
    """The URL of a policy row as the feed has it."""
    return trim_u(F.coalesce(F.col("source_url").cast("string"), F.lit("")))


def feed_records(policies: DataFrame, as_of: Column) -> DataFrame:
    """Feed records of policy rows (source_url, title, publish_date, content, issuing_authority, seq)."""
    text = lambda c: trim_u(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return policies.select(
        F.lit(None).cast("string").alias("id"),
        text("title").alias("title"),
        feed_url().alias("url"),
        text("publish_date").alias("publish_date"),
        preview(F.col("content")).alias("content_preview"),
        text("issuing_authority").alias("source_site"),
        as_of.cast("string").alias("created_at"),
        (F.lit(_NEW) + F.col("seq")).alias("ord"),
    ).where("url <> ''")


def merge_feed(existing: DataFrame, policies: DataFrame, as_of: Column) -> DataFrame:
    """Feed after a run: by URL the last record counts, with the id and place of the first.

    ``existing`` has the feed columns and ``pos``; ``policies`` has ``seq``. Rows of the run get
    ``created_at = as_of`` even where the URL was known; all others stay word for word. The result
    carries ``ord``, the order among equal dates, and ``is_added``. Only URLs and places are aggregated.
    """
    stored = existing.where("coalesce(url, '') <> ''").select(
        *FEED_COLUMNS, F.col("pos").cast("bigint").alias("ord")
    )
    both = with_rows(stored.unionByName(feed_records(policies, as_of)))
    is_old = F.col("ord") < _NEW
    keys = both.groupBy(F.col("url").alias("_url")).agg(
        F.max_by(ROW, "ord").alias("_last"),
        F.max_by(ROW, F.when(is_old, F.col("ord"))).alias("_last_old"),
        F.min("ord").alias("_ord"),
        F.count(F.lit(1)).alias("_times"),
    )
    ids = both.where(is_old).select(F.col(ROW).alias("_of"), F.col("id").alias("_old_id"))
    repeated = keys.where("_times > 1").join(ids, F.col("_last_old") == F.col("_of"), "left").drop("_times", "_of", "_last_old")
    repeated = thin_side(stage(repeated))
    rows = both.join(repeated, F.col("url") == F.col("_url"), "left").where(F.col("_last").isNull() | (F.col("_last") == F.col(ROW)))
    old_id = F.when(F.col("_last").isNull(), F.col("id")).otherwise(F.col("_old_id"))
    first = F.coalesce("_ord", "ord")
    return rows.select(
        # A record the run does not touch keeps its id, be it blank.
        F.when(is_old, old_id).otherwise(feed_id(F.col("url"), old_id)).alias("id"),
        "title",
        "url",
        "publish_date",
        "content_preview",
        "source_site",
        "created_at",
        first.alias("ord"),
        (first >= _NEW).alias("is_added"),
    )


def feed_order(feed: DataFrame) -> list[Column]:
    return [F.desc(F.coalesce("publish_date", F.lit(""))), F.asc("ord")]


def positioned_feed(feed: DataFrame, parts: int | None = None) -> DataFrame:
    """Feed columns and ``pos``, counting from 0 in published order."""
    dated = feed.withColumn("_date", F.coalesce("publish_date", F.lit("")))
    numbered = number_rows(dated, "ord", out="pos", start=0, descending=["_date"], parts=parts)
    return numbered.select(*FEED_COLUMNS, "pos")


# ---------------------------------------------------------------- audit


def feed_audit(feed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row: records, complete records, duplicate URLs, neighbours out of date order.

    ``feed`` has the feed columns and ``pos`` (dense). Neighbours are compared within chunks of
    positions; the first record of a chunk also closes the chunk before it.
    """
    complete = F.lit(True)
    for c in FEED_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    totals = feed.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(complete).alias("complete"),
        (F.count("url") - F.countDistinct("url")).alias("duplicate_urls"),
    )
    return totals.withColumn("out_of_order", out_of_order(feed, chunk).scalar())


def out_of_order(feed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row: how many records are newer than the record before them."""
    own = F.floor(F.col("pos") / chunk)
    opens = (F.col("pos") % chunk == 0) & (F.col("pos") > 0)
    homes = F.when(opens, F.array(own, own - 1)).otherwise(F.array(own))
    thin = feed.select("pos", F.coalesce("publish_date", F.lit("")).alias("d"), F.explode(homes).alias("c"))
    before = F.lag("d").over(Window.partitionBy("c").orderBy("pos"))
    return thin.select((F.col("d") > before).alias("bad")).agg(F.count_if("bad").alias("out_of_order"))


def site_distribution(feed: DataFrame) -> DataFrame:
    return feed.groupBy("source_site").agg(F.count(F.lit(1)).alias("records"))
