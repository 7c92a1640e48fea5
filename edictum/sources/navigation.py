"""Navigation files and registry files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edictum import schemas


def read_navigation(spark: SparkSession, path: str) -> DataFrame:
    """Navigation rows (category, pos, name, area, portal_url) of a JSON file; a byte-order mark is fine."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("value"))
    return (
        whole.select(F.explode(F.from_json("value", schemas.NAVIGATION)).alias("category", "entries"))
        .select("category", F.posexplode("entries").alias("pos", "e"))
        .select("category", "pos", "e.name", "e.area", "e.portal_url")
    )


def write_registry(sources: DataFrame, path: str) -> None:
    sources.write.mode("overwrite").json(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry rows written by :func:`write_registry`."""
    columns = (
        "id string, name string, area string, base string, portal_url string, list_url string, "
        "parser string, keep_paths array<string>, enabled boolean"
    )
    return spark.read.schema(columns).json(path)
