"""Document pages to document records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.functions.dates import iso_date
from edictum.functions.text import clean_html_text, doc_number, first_nonblank, let, trim_u, unescape
from edictum.functions.urls import resolve_urls
from edictum.operators.registry import ATTACHMENT, DOWNLOAD, IMAGE, RULE_COLUMNS, with_profile

TEXT_RULES = ["title_rules", "content_rules", "doc_number_rules", "authority_rules"]


def _extract(html: Column, pattern: Column) -> Column:
    return F.call_function("regexp_extract", html, pattern, F.lit(1))


def first_text(html: Column, rules: Column) -> Column:
    """Text of the first rule that finds enough of it, ``''`` if none does.

    Later rules are not evaluated once one has matched.
    """

    def apply(rule: Column) -> Column:
        found = _extract(html, rule["pattern"])
        text = let(found, lambda v: F.when(rule["plain"], trim_u(v)).otherwise(clean_html_text(v)))
        return let(text, lambda t: F.when(F.length(t) >= rule["min_len"], t))

    found = F.aggregate(rules, F.lit(None).cast("string"), lambda acc, rule: F.coalesce(acc, apply(rule)))
    return F.coalesce(found, F.lit(""))


def first_date(html: Column, patterns: Column) -> Column:
    """First labelled date, zero-padded; day and month are not checked."""
    found = F.aggregate(
        patterns,
        F.lit(None).cast("string"),
        lambda acc, p: F.coalesce(acc, F.nullif(_extract(html, p), F.lit(""))),
    )
    return let(F.coalesce(found, F.lit("")), lambda d: F.when(d == "", d).otherwise(iso_date(d)))


def links(html: Column, base: Column) -> Column:
    """Two arrays of absolute links, attachments and images, each link once, in order."""
    found = [F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in (ATTACHMENT, DOWNLOAD, IMAGE)]

    def absolute(hrefs: Column) -> Column:
        own = F.transform(F.array_distinct(hrefs), unescape)
        urls = let(own, lambda found: F.array_distinct(resolve_urls(base, found)))
        return F.transform(urls, lambda u: F.struct(u.alias("url")))

    return F.transform(F.array(F.concat(found[0], found[1]), found[2]), absolute)


def document_records(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Document records of pages that carry url, html and extraction rules. No shuffle.

    ``keep`` names further columns to pass through, such as ``source``.
    """
    html, url = F.col("html"), F.col("url")
    # One expression for the four text fields: the plan holds the text rules once.
    texts = F.transform(F.array(*[F.col(c) for c in TEXT_RULES]), lambda rules: first_text(html, rules))
    found = pages.select(
        *keep,
        "url",
        texts.alias("texts"),
        first_date(html, F.col("date_patterns")).alias("publish_date"),
        links(html, url).alias("links"),
        html.alias("raw_html"),
    )
    title, content, own_number, authority = (F.get("texts", F.lit(i)) for i in range(len(TEXT_RULES)))
    return found.select(
        *keep,
        "url",
        title.alias("title"),
        first_nonblank(doc_number(content), own_number).alias("doc_number"),
        "publish_date",
        F.lit("").alias("implement_date"),
        content.alias("content"),
        authority.alias("issuing_authority"),
        F.get("links", F.lit(0)).alias("attachments"),
        F.get("links", F.lit(1)).alias("images"),
        "raw_html",
    )


def parse_documents(pages: DataFrame, sources: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Document records, each page read with the rules of its own source in one pass.

    ``keep`` names further columns to pass through. Pages stay where they are if Spark knows the
    registry to be small; stage one that comes out of a query.
    """
    rules = sources.select(F.col("id").alias("source"), *RULE_COLUMNS)
    return document_records(pages.join(rules, "source"), keep=("source", *keep))


def parse_documents_as(pages: DataFrame, parser: str = "generic", **overrides) -> DataFrame:
    """Document records of a table of pages that all follow one parser."""
    return document_records(with_profile(pages, parser, **overrides))
