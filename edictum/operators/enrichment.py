"""Make policy rows ready to store: add attachment text, set the status, mask personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.functions.dates import validity_status
from edictum.functions.names import fresh
from edictum.functions.text import let, scrub_pii, trim_u
from edictum.session import stage

SHORT = 100
# Markers before added text.
ATTACHMENT_MARK = "\n[附件] "
IMAGE_MARK = "\n[图片OCR] "


def _links(df: DataFrame, column: str, kind: str) -> Column:
    """Array of (kind, pos, url, file) for one link column; a missing column has no links."""
    if column not in df.columns:
        return F.from_json(F.lit("[]"), "array<struct<kind:string,pos:int,url:string,file:string>>")
    fields = df.schema[column].dataType.elementType.fieldNames()
    file = (lambda a: a["file"]) if "file" in fields else (lambda a: F.lit(None).cast("string"))
    return F.transform(
        F.coalesce(F.col(column), F.array()),
        lambda a, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), a["url"].alias("url"), file(a).alias("file")
        ),
    )


def enrich_content(
    policies: DataFrame,
    attachment_text: DataFrame,
    key: str = "source_url",
    attachments: str = "attachments",
    images: str = "images",
) -> DataFrame:
    """Extend content shorter than 100 characters by the text of its attachments and images.

    All attachments with text are appended in order; a Word file counts only if it has a local
    file, a PDF always. If the content is still short, the first image with text follows. ``key``
    identifies a row. What is joined are links with texts. Long rows take part in no join, and short
    ones stay where they are, raw page and all, if Spark finds the staged texts they get to be small.
    """
    content = F.coalesce(F.col("content"), F.lit(""))
    short = policies.where(F.length(content) < SHORT)
    lower = F.lower(F.col("link.url"))
    is_pdf = F.endswith(lower, F.lit(".pdf"))
    is_word = F.endswith(lower, F.lit(".docx")) | F.endswith(lower, F.lit(".doc"))
    has_file = F.coalesce(F.col("link.file"), F.lit("")) != ""
    links = (
        short.select(
            key,
            F.explode(F.concat(_links(policies, attachments, "doc"), _links(policies, images, "image"))).alias("link"),
        )
        .where((F.col("link.kind") == "image") | is_pdf | (is_word & has_file))
        .select(key, "link.kind", "link.pos", "link.url")
    )
    texts = (
        attachment_text.select("kind", "url", trim_u(F.col("text")).alias("text"))
        .where("text <> ''")
        .groupBy("kind", "url")
        .agg(F.min("text").alias("text"))
    )
    found = links.join(texts, ["kind", "url"])
    # One group is the links of one page.
    in_order = F.array_sort(F.collect_list(F.when(F.col("kind") == "doc", F.struct("pos", "text"))))
    added = found.groupBy(key).agg(
        F.array_join(F.transform(in_order, lambda e: F.concat(F.lit(ATTACHMENT_MARK), e["text"])), "").alias("docs"),
        F.min_by("text", F.when(F.col("kind") == "image", F.col("pos"))).alias("image"),
    )
    of, docs, image = fresh(policies, "of", "docs", "image")
    added = stage(added.select(F.col(key).alias(of), F.col("docs").alias(docs), F.col("image").alias(image)))
    with_docs = F.when(F.coalesce(docs, F.lit("")) != "", trim_u(F.concat(content, F.col(docs)))).otherwise(content)
    with_image = let(
        with_docs,
        lambda text: F.when(
            (F.length(text) < SHORT) & F.col(image).isNotNull(), trim_u(F.concat(text, F.lit(IMAGE_MARK), F.col(image)))
        ).otherwise(text),
    )
    extended = short.join(added, F.col(key) == F.col(of), "left").withColumn("content", with_image)
    return extended.select(*policies.columns).unionByName(policies.where(F.length(content) >= SHORT))


def prepare_policies(policies: DataFrame, as_of, scrub: bool = True) -> DataFrame:
    """Status from the title as it came, then personal data masked in all stored text."""
    ready = policies.withColumn("validity_status", validity_status(F.col("title"), F.col("publish_date"), as_of))
    if scrub:
        texts = [c for c in ("content", "title", "raw_html", "doc_number") if c in policies.columns]
        ready = ready.withColumns({c: scrub_pii(F.col(c)) for c in texts})
    return ready


def recompute_validity(policies: DataFrame, as_of) -> DataFrame:
    """Bring the status of stored rows up to a date; a future policy takes effect over time."""
    return policies.withColumn("validity_status", validity_status(F.col("title"), F.col("publish_date"), as_of))
