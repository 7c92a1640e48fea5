"""The feed as files: JSON Lines for exchange between runs, a JSON array for web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edictum import schemas
from edictum.operators.feed import positioned_feed
from edictum.session import stage
from edictum.sources.tables import empty, path_exists

_STORED = schemas.FEED + ", pos bigint"


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """A feed written by :func:`write_feed`; a missing path is empty, unreadable lines are left out."""
    if not path_exists(spark, path):
        return empty(spark, _STORED)
    lines = spark.read.text(path)
    # A line is valid JSON or it does not count; a broken one is never read in part.
    parsed = lines.where(F.json_object_keys("value").isNotNull()).select(F.from_json("value", _STORED).alias("r"))
    return parsed.select("r.*")


def read_feed_array(spark: SparkSession, path: str) -> DataFrame:
    """A feed in one JSON array file, with ``pos``.

    Missing, unreadable or not an array: empty. A single array cannot be split, so this is for
    files small enough to be published as one; between runs use :func:`read_feed`.
    """
    if not path_exists(spark, path):
        return empty(spark, _STORED)
    text = F.regexp_replace("value", "^﻿", "")
    whole = spark.read.text(path, wholetext=True).select(text.alias("value"))
    records = F.from_json("value", f"array<struct<{_nested(schemas.FEED)}>>")
    return (
        whole.where(F.json_array_length("value").isNotNull())
        .select(F.posexplode(records).alias("pos", "r"))
        .select("r.*", F.col("pos").cast("bigint").alias("pos"))
    )


def read_feed_array_parts(spark: SparkSession, path: str) -> DataFrame:
    """Records of a feed written by :func:`write_feed_array`, line by line, so its parts are read in parallel."""
    if not path_exists(spark, path):
        return empty(spark, schemas.FEED)
    record = F.regexp_replace("value", r"^[\[,]|\]$", "")
    parsed = spark.read.text(path).select(record.alias("value")).where(F.json_object_keys("value").isNotNull())
    return parsed.select(F.from_json("value", schemas.FEED).alias("r")).select("r.*")


def _nested(schema: str) -> str:
    return ",".join(":".join(f.split()) for f in schema.split(","))


def write_feed(feed: DataFrame, path: str) -> bool:
    """Write a merged feed as JSON Lines, in published order across the part files.

    Writes nothing, and says so, when the feed is empty. The order comes from a range-partitioned
    sort; no file or task gets the whole feed.
    """
    feed = stage(feed)
    if feed.isEmpty():
        return False
    positioned_feed(feed).orderBy("pos").write.mode("overwrite").json(path)
    return True


def write_feed_array(feed: DataFrame, path: str) -> bool:
    """Write a merged feed so that its part files, joined in name order, are one JSON array."""
    feed = stage(feed)
    if feed.isEmpty():
        return False
    last = feed.agg(F.count(F.lit(1)) - 1).scalar()
    record = F.to_json(F.struct(*schemas.FEED_COLUMNS), {"ignoreNullFields": "false"})
    opening = F.when(F.col("pos") == 0, F.lit("[")).otherwise(F.lit(","))
    closing = F.when(F.col("pos") == last, F.lit("]")).otherwise(F.lit(""))
    positioned_feed(feed).orderBy("pos").select(F.concat(opening, record, closing).alias("value")).write.mode(
        "overwrite"
    ).text(path)
    return True
