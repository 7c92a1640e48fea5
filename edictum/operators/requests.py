"""The request log: outcomes, voided runs, retention, politeness, source health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edictum.functions.dates import as_date
from edictum.functions.urls import url_host
from edictum.operators.registry import enabled_sources
from edictum.operators.skew import lookup

# Fixed values of the crawl rules.
BLOCKED = 403
RETENTION_DAYS = 180
MIN_GAP_SECONDS = 4.0
# Requests of a host are compared within minutes, so no host is sorted as a whole.
_BUCKET_SECONDS = 60


def outcomes(log: DataFrame) -> DataFrame:
    """Per run and URL: status of the last attempt, attempts, whether it brought a page."""
    return (
        log.groupBy("run_id", "url")
        .agg(F.max_by("status", "seq").alias("status"), F.count(F.lit(1)).alias("attempts"))
        .withColumn("fetched", ~F.col("status").isin(0, BLOCKED))
    )


def blocked_runs(log: DataFrame) -> DataFrame:
    """Runs that met a block, with the first blocked request."""
    return log.where(F.col("status") == BLOCKED).groupBy("run_id").agg(F.min("seq").alias("blocked_at"))


def without_blocked_runs(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of runs that met no block: a blocked run publishes nothing."""
    return lookup(rows, blocked_runs(log).select("run_id"), "run_id", "left_anti")


def until_block(log: DataFrame) -> DataFrame:
    """Requests up to and including the first block of their run.

    The block is found by a pre-aggregated minimum per run, not by sorting the run, and the rows
    of one run are spread over several tasks to meet it.
    """
    return (
        lookup(log, blocked_runs(log), "run_id")
        .where(F.col("blocked_at").isNull() | (F.col("seq") <= F.col("blocked_at")))
        .select(*log.columns)
    )


def retained(log: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Requests of the last ``days`` days; a log stored by day is read only from there on."""
    first = F.date_sub(as_date(as_of), days)
    kept = log.where(F.col("ts") >= first.cast("timestamp"))
    return kept.where(F.col("day") >= first) if "day" in log.columns else kept


def politeness(log: DataFrame, min_gap: float = MIN_GAP_SECONDS) -> DataFrame:
    """Per host: requests, pairs of successive requests closer than ``min_gap`` seconds, least gap.

    Requests at one instant merge before the shuffle. Gaps are taken within a minute of a host,
    and between minutes from each minute's first and last instant.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    instants = (
        log.select(url_host(F.col("url")).alias("host"), micros.alias("at"))
        .groupBy("host", "at")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.floor(F.col("at") / (_BUCKET_SECONDS * 1_000_000)))
    )
    limit = int(min_gap * 1_000_000)
    inside = Window.partitionBy("host", "bucket").orderBy("at")
    steps = instants.withColumn("step", F.col("at") - F.lag("at").over(inside))
    same_instant = F.when(F.col("n") > 1, F.lit(0))
    repeats = F.sum(F.col("n") - 1) if limit > 0 else F.lit(0)
    per_bucket = steps.groupBy("host", "bucket").agg(
        F.sum("n").alias("requests"),
        (repeats + F.count_if(F.col("step") < limit)).alias("close"),
        F.min(F.least(same_instant, F.col("step"))).alias("least"),
        F.min("at").alias("first"),
        F.max("at").alias("last"),
    )
    across = F.col("first") - F.lag("last").over(Window.partitionBy("host").orderBy("bucket"))
    return (
        per_bucket.withColumn("across", across)
        .groupBy("host")
        .agg(
            F.sum("requests").alias("requests"),
            (F.sum("close") + F.count_if(F.col("across") < limit)).alias("too_close"),
            (F.min(F.least("least", "across")) / 1_000_000).alias("least_gap"),
        )
    )


# ---------------------------------------------------------------- source health


def status_class(status: Column) -> Column:
    return (
        F.when(status.isNull(), "no response")
        .when(status < 400, "ok")
        .when(status.isin(403, 412), "blocked")
        .otherwise("fail")
    )


def status_detail(status: Column) -> Column:
    """The wording of a probe result."""
    text = F.concat(F.lit("HTTP "), status.cast("string"))
    return (
        F.when(status.isNull(), F.lit("无响应"))
        .when(status.isin(403, 412), F.concat(text, F.lit("（站点可达，但被反爬拦截）")))
        .otherwise(text)
    )


def latest_probe(log: DataFrame) -> DataFrame:
    """Last status of each URL; an attempt without an answer (0) has none."""
    return log.groupBy("url").agg(F.nullif(F.max_by("status", F.struct("ts", "seq")), F.lit(0)).alias("status"))


def source_health(sources: DataFrame, log: DataFrame) -> DataFrame:
    """Per enabled source: whether its list page answered last time."""
    probed = enabled_sources(sources).select(F.col("id").alias("source"), F.col("list_url").alias("url"))
    status = F.col("status")
    probes = log.join(probed.select("url"), "url", "left_semi")
    return probed.join(latest_probe(probes), "url", "left").select(
        "source",
        "url",
        (status_class(status) == "ok").alias("ok"),
        status_detail(status).alias("detail"),
    )


def health_report(
    sources: DataFrame, log: DataFrame, policies: DataFrame | None, now: Column, problem: str = ""
) -> DataFrame:
    """One row with the whole report as JSON, and the overall verdict.

    Without ``policies`` the store could not be read: ``problem`` says why, and the verdict is no.
    """
    health = source_health(sources, log)
    entries = health.agg(
        (F.coalesce(F.bool_and("ok"), F.lit(True)) & F.lit(policies is not None)).alias("ok"),
        F.array_sort(F.collect_list(F.struct("source", "url", "ok", "detail"))).alias("sources"),  # small registry
    )
    # The wording about the store.
    if policies is None:
        detail = F.lit(f"数据库异常: {problem}")
    else:
        count = policies.agg(F.count(F.lit(1)).alias("n")).scalar()
        detail = F.concat(F.lit("数据库正常，政策 "), count.cast("string"), F.lit(" 条"))
    db = F.struct(F.lit(policies is not None).alias("ok"), detail.alias("detail"))
    report = F.struct("ok", now.cast("string").alias("checked_at"), db.alias("db"), "sources")
    return entries.select("ok", F.to_json(report).alias("report"))
