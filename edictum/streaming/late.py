"""Distinct rows behind a watermark, with every row that does not come through kept for inspection.

The engine's own watermark drops late rows without a trace. Here each micro-batch sorts its rows into
outcomes and writes all of them, so that what came in is what went out: ``new``, the first row of a URL;
``repeated``, further rows of a URL that is still remembered; ``late``, rows behind the watermark;
``undated``, rows without an event time, which no watermark can pass. A small commit file per batch holds
the newest event time; what no commit names is not there, and a replayed batch changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edictum.functions.names import fresh
from edictum.operators.skew import lookup
from edictum.session import stage
from edictum.sources.tables import commit_file, path_exists

OUTCOMES = ("new", "repeated", "late", "undated")


def commits(spark: SparkSession, path: str) -> dict[int, int | None]:
    """Newest event time so far, in microseconds, by committed batch; NULL where no row had one."""
    if not path_exists(spark, f"{path}/commits"):
        return {}
    rows = spark.read.schema("batch bigint, newest bigint").json(f"{path}/commits").collect()  # one short row a batch
    return {r["batch"]: r["newest"] for r in rows}


def sort_out(rows: DataFrame, seen: DataFrame, watermark: int | None, event_time: str, key: str, order: str) -> DataFrame:
    """``rows`` with ``outcome``; ``seen`` holds (key, expires) of the URLs still remembered.

    Of the rows of a URL in one batch the first by event time, then ``order``, is the new one; ``order``
    tells rows apart. A row without a URL is new, as nothing can repeat it.
    """
    at, first, known = fresh([*rows.columns, "outcome"], "at", "first", "known")
    timed = rows.withColumn(at, F.unix_micros(F.col(event_time).cast("timestamp")))
    on_time = F.lit(True) if watermark is None else F.col(at) >= watermark
    firsts = timed.where(F.col(at).isNotNull() & on_time).groupBy(key).agg(F.min(F.struct(at, order)).alias(first))
    firsts = firsts.join(seen.select(F.col("key").alias(known)), F.col(key) == F.col(known), "left")
    same = (F.col(at) == F.col(f"{first}.{at}")) & (F.col(order) == F.col(f"{first}.{order}"))
    outcome = (
        F.when(F.col(at).isNull(), "undated")
        .when(~on_time, "late")
        .when(F.col(key).isNull() | (F.col(known).isNull() & same), "new")
        .otherwise("repeated")
    )
    return lookup(timed, firsts, key).select(*rows.columns, outcome.alias("outcome"))


def ingest_rows(
    batch: DataFrame, batch_id: int, path: str, event_time: str, delay_days: int, key: str = "source_url", order: str = "seq"
) -> bool:
    """Write the rows of a micro-batch by outcome and remember its new URLs; False if it was committed before.

    The watermark is that of the batches before: the newest event time less ``delay_days``. A URL is
    remembered until the watermark has passed its first row by as much. What is remembered is written
    with each batch, in proportion to the URLs of the delay and not to all there ever were.
    """
    if taken := {"outcome", "batch"} & {c.lower() for c in batch.columns}:
        raise ValueError(f"columns of these names are written beside the rows: {sorted(taken)}")
    spark, done = batch.sparkSession, commits(batch.sparkSession, path)
    if batch_id in done:
        return False
    delay = delay_days * 86_400_000_000
    earlier = {n: newest for n, newest in done.items() if n < batch_id}
    newest = max((n for n in earlier.values() if n is not None), default=None)
    watermark = None if newest is None else newest - delay
    state = "key string, expires bigint"
    seen = spark.read.schema(state).parquet(f"{path}/seen/batch={max(earlier)}") if earlier else spark.createDataFrame([], state)
    if watermark is not None:
        seen = seen.where(F.col("expires") > watermark)
    rows = stage(batch)
    sort_out(rows, seen, watermark, event_time, key, order).write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/rows/batch={batch_id}")
    written = read_batch(spark, rows, path, batch_id)
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    fresh_urls = written.where((F.col("outcome") == "new") & F.col(key).isNotNull()).select(F.col(key).alias("key"), (at + delay).alias("expires"))
    seen.unionByName(fresh_urls).write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")
    own = rows.agg(F.max(at)).first()[0]
    newest = max((t for t in (newest, own) if t is not None), default=None)
    return commit_file(spark, f"{path}/commits/{batch_id:012d}.json", json.dumps({"batch": batch_id, "newest": newest}))


def read_batch(spark: SparkSession, like: DataFrame, path: str, batch_id: int) -> DataFrame:
    kinds = like.schema.add("outcome", "string")
    return spark.read.schema(kinds).parquet(f"{path}/rows/batch={batch_id}")


def read_rows(spark: SparkSession, path: str, *outcomes: str) -> DataFrame:
    """All committed rows with ``outcome`` and ``batch``, or those of some outcomes, whose folders alone are read."""
    done = commits(spark, path)
    if not done:
        raise ValueError(f"nothing committed under {path}")
    folders = [f"{path}/rows/batch={n}" for n in sorted(done)]
    rows = spark.read.option("basePath", f"{path}/rows").parquet(*folders)
    return rows.where(F.col("outcome").isin(*outcomes)) if outcomes else rows


def start_rows(
    stream: DataFrame, path: str, checkpoint: str, event_time: str, delay_days: int, key: str = "source_url", order: str = "seq"
) -> StreamingQuery:
    """Sort a stream into outcomes, a micro-batch at a time; ends when the input is used up."""
    return (
        stream.writeStream.foreachBatch(lambda batch, n: ingest_rows(batch, n, path, event_time, delay_days, key, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
