"""Counts, summaries and audits of the policy table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.functions.dates import as_date, parse_date
from edictum.functions.text import trim_u
from edictum.operators.registry import enabled_sources

# Fixed value: the URL shape of made-up demonstration rows.
PLACEHOLDER_URL = r"/123456\.html$"


def _created_since(as_of, days: int) -> Column:
    created, today = F.to_date("created_at"), as_date(as_of)
    return created == today if days <= 0 else created >= F.date_sub(today, days)


def added_since(policies: DataFrame, days: int, as_of) -> DataFrame:
    """Policies added today (``days <= 0``) or since ``days`` days ago, both ends included."""
    return policies.agg(F.count_if(_created_since(as_of, days)).alias("added"))


def latest_stats(policies: DataFrame, as_of, days: int = 7) -> DataFrame:
    """One row: added today, added in the week."""
    return policies.agg(
        F.count_if(_created_since(as_of, 0)).alias("today"), F.count_if(_created_since(as_of, days)).alias("week")
    )


def health_summary(policies: DataFrame, sources: DataFrame, now: Column) -> DataFrame:
    """One row: ok, number of policies, enabled source ids in order, time."""
    ids = enabled_sources(sources).agg(F.array_sort(F.collect_set("id")))  # the registry is small
    return policies.agg(F.count(F.lit(1)).alias("policies")).select(
        F.lit(True).alias("ok"), "policies", ids.scalar().alias("sources_enabled"), now.alias("time")
    )


def build_report(items: DataFrame, documents: DataFrame, matches: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per registered source: items listed, its first document's fields, the title it was matched to.

    A source without items or documents has its row too, with zeros and blanks.
    ``documents`` carries source and page_id; ``matches`` comes from ``match_titles``.
    """
    listed = items.groupBy("source").agg(F.count(F.lit(1)).alias("list_items"))
    first = documents.groupBy("source").agg(
        F.min_by(
            F.struct(
                "url", "title", "publish_date", "doc_number", "issuing_authority",
                F.length("content").alias("content_len"), F.size("attachments").alias("attachments"),
            ),
            F.struct("page_id", "url"),
        ).alias("d")
    )
    first = first.select("source", "d.*")
    hits = matches.select("source", "url", F.col("item_title").alias("matched_item"))
    names = sources.select(F.col("id").alias("source"), F.col("name").alias("source_name"))
    report = names.join(listed, "source", "left").join(first, "source", "left").join(hits, ["source", "url"], "left")
    return report.select(
        "source",
        F.coalesce("list_items", F.lit(0)).alias("list_items"),
        F.coalesce("title", F.lit("")).alias("detail_title"),
        F.coalesce("publish_date", F.lit("")).alias("detail_date"),
        F.coalesce("doc_number", F.lit("")).alias("detail_doc_number"),
        F.coalesce(F.nullif("issuing_authority", F.lit("")), "source_name", F.lit("")).alias("detail_authority"),
        F.coalesce("content_len", F.lit(0)).alias("detail_content_len"),
        F.coalesce("attachments", F.lit(0)).alias("attachments"),
        "matched_item",
    )


def _blank(name: str) -> Column:
    return trim_u(F.coalesce(F.col(name).cast("string"), F.lit(""))) == ""


def _quality_counts(policies: DataFrame) -> list[Column]:
    missing = _blank("title") | _blank("source_url") | _blank("publish_date") | _blank("issuing_authority")
    day = F.col("publish_date").cast("string")
    malformed = ~_blank("publish_date") & (~day.rlike(r"^\d{4}-\d\d-\d\d$") | parse_date(day).isNull())
    counts = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(missing).alias("missing_required"),
        F.count_if(malformed).alias("malformed_dates"),
        F.count_if(F.col("source_url").rlike(PLACEHOLDER_URL)).alias("placeholder_urls"),
        F.count_if(~_blank("content")).alias("with_content"),
    ]
    if "attachment_links" in policies.columns:
        counts.append(F.count_if(F.size("attachment_links") > 0).alias("with_attachments"))
    return counts


def policy_audit(policies: DataFrame, approximate: bool = False) -> DataFrame:
    """One row of quality counts. ``approximate`` sketches the distinct URLs instead of shuffling them."""
    distinct = F.approx_count_distinct("source_url") if approximate else F.countDistinct("source_url")
    return policies.agg(*_quality_counts(policies), (F.count("source_url") - distinct).alias("duplicate_urls"))


# ---------------------------------------------------------------- audits kept beside a growing table

URL_SKETCH = 14  # 2^14 registers: a standard error of 0.8 per cent, 16 KB a part


def audit_part(policies: DataFrame) -> DataFrame:
    """One row: what the audit needs to know of a part of the table, to be stored when the part is written.

    Counts can be added, and the sketch of its URLs merged, so the part need not be read again. A part
    without rows has its row of zeros.
    """
    sketch = F.hll_sketch_agg("source_url", F.lit(URL_SKETCH)).alias("url_sketch")
    return policies.agg(*_quality_counts(policies), F.count("source_url").alias("urls"), sketch)


def audit_of_parts(parts: DataFrame) -> DataFrame:
    """The audit of all parts from their stored rows: every count exact, the distinct URLs within the sketch's error.

    URLs that lie in several parts count as duplicates, as in :func:`policy_audit`. Without any part
    there is a row of zeros.
    """
    added = [c for c in parts.columns if c not in ("urls", "url_sketch")]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in added]
    distinct = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("url_sketch")), F.lit(0))
    duplicate = F.greatest(F.coalesce(F.sum("urls"), F.lit(0)) - distinct, F.lit(0)).alias("duplicate_urls")
    return parts.agg(*sums, duplicate)


def rows_per_authority(policies: DataFrame) -> DataFrame:
    return policies.groupBy("issuing_authority").agg(F.count(F.lit(1)).alias("policies"))
