"""Incremental ingest: the batch operators over streams of policy rows.

The streamed table is a log of changes, one folder per micro-batch, and the current table is the
last change of each URL. A batch that runs again overwrites its own folder, so the result of a
replay is the result of one run; and a batch writes in proportion to itself, not to the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edictum.functions.dates import parse_date
from edictum.functions.text import first_nonblank
from edictum.operators.details import parse_documents
from edictum.operators.enrichment import prepare_policies
from edictum.operators.skew import thin_side
from edictum.operators.upsert import accepted, latest_per_key
from edictum.session import stage
from edictum.sources.tables import path_exists


def write_changes(batch: DataFrame, batch_id: int, path: str, key: str = "source_url", order: str = "seq") -> None:
    """Store the last row per URL of a micro-batch in the batch's own folder."""
    last = latest_per_key(accepted(batch), key, order).withColumn("batch", F.lit(batch_id).cast("bigint"))
    last.write.mode("overwrite").parquet(f"{path}/batch_{batch_id}")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/batch_*")


def current_rows(changes: DataFrame, key: str = "source_url") -> DataFrame:
    """The table after all changes: last values, creation time and first position of the first.

    ``received_at`` of the first change is the creation time, that of the last the update time. Only URLs
    and batches are aggregated; a URL that changed once keeps its row as it is.
    """
    own = [c for c in changes.columns if c not in (key, "batch", "first_seq", "received_at", "seq")]
    keys = changes.groupBy(F.col(key).alias("_key")).agg(
        F.max("batch").alias("_last"),
        F.min("batch").alias("_first"),
        F.count(F.lit(1)).alias("_changes"),
    )
    firsts = changes.select(F.col(key).alias("_of"), F.col("batch").alias("_batch"), F.col("received_at").alias("_created"), F.col("first_seq").alias("_seq"))
    same = (F.col("_key") == F.col("_of")) & (F.col("_first") == F.col("_batch"))
    repeated = thin_side(stage(keys.where("_changes > 1").join(firsts, same).drop("_of", "_batch", "_first")))
    rows = changes.join(repeated, F.col(key) == F.col("_key"), "left").where(F.col("_last").isNull() | (F.col("batch") == F.col("_last")))
    return rows.select(
        key,
        *own,
        F.coalesce("_created", "received_at").alias("created_at"),
        F.col("received_at").alias("updated_at"),
        F.coalesce("_seq", "first_seq").alias("first_seq"),
        F.coalesce("_changes", F.lit(1)).alias("changes"),
    )


def start_ingest(stream: DataFrame, path: str, checkpoint: str, now: Column | None = None) -> StreamingQuery:
    """Ingest a stream of policy rows with ``seq`` into a change log; ends when input is used up."""
    received = F.current_timestamp() if now is None else now
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: write_changes(batch.withColumn("received_at", received), batch_id, path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the current rows as a table of their own."""
    current_rows(read_changes(spark, path)).write.mode("overwrite").parquet(target)


def document_rows(pages: DataFrame, sources: DataFrame, as_of, scrub: bool = True) -> DataFrame:
    """Policy rows of document pages (page_id, source, url, html), ready for :func:`start_ingest`.

    Parsing is stateless, so ``pages`` may be a stream or a table. ``seq`` is the page id.
    """
    sources = stage(sources)
    names = sources.select(F.col("id").alias("source"), F.col("name").alias("source_name"))
    records = parse_documents(pages, sources, keep=("page_id",)).join(names, "source")
    rows = records.select(
        F.col("page_id").alias("seq"),
        F.col("url").alias("source_url"),
        "title",
        "doc_number",
        first_nonblank(F.col("issuing_authority"), F.col("source_name")).alias("issuing_authority"),
        "publish_date",
        "content",
        "attachments",
        "images",
    )
    return prepare_policies(rows, as_of, scrub)


# ---------------------------------------------------------------- event-time operators


def distinct_urls(stream: DataFrame, event_time: str, delay: str) -> DataFrame:
    """First row of each URL; the state of a URL is dropped once the watermark has passed it."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["source_url"])


def added_per_day(stream: DataFrame, event_time: str = "created_at", delay: str = "1 day") -> DataFrame:
    """New policies per day, each day once it is over."""
    counts = (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day"))
        .agg(F.count(F.lit(1)).alias("added"))
    )
    return counts.select(F.to_date("window.start").alias("day"), "added")


def recent_distinct(stream: DataFrame, days: int, date: str = "date") -> DataFrame:
    """Distinct dated rows no older than ``days`` behind the newest seen, and all undated rows.

    An undated row has no event time and would never pass a watermark, so it goes around it.
    """
    day = parse_date(F.col(date)).cast("timestamp")
    dated = stream.withColumn("event_time", day).where("event_time IS NOT NULL")
    undated = stream.where(day.isNull())
    kept = distinct_urls(dated, "event_time", f"{days} days").drop("event_time")
    return kept.unionByName(undated)


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a streaming query over the input there is, into files, and read them back."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, path):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(path)
