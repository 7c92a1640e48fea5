"""Link list items to document records: by URL, or by one title containing the other."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.functions.text import first_nonblank, trim_u
from edictum.operators.containment import held_texts
from edictum.session import stage

_LONG, _SHORT = (24, 8), (8, 4)  # characters of a gram, one place in so many: only _anchors and its test use them


def link_by_url(items: DataFrame, documents: DataFrame, sources: DataFrame, runs: Iterable[str] = ()) -> DataFrame:
    """Policy rows of items whose page was read; blank document fields fall back to the item.

    A URL that appears on several list pages gives one row per appearance, told apart by
    (page_id, pos); the merge keeps the last. ``runs`` names columns both sides carry that must
    agree besides the URL, such as ``run_id``.
    """
    names = sources.select(F.col("id").alias("source"), F.col("name").alias("source_name"))
    doc = documents.select(
        *runs,
        "url",
        *[F.col(c).alias(f"doc_{c}") for c in ("title", "publish_date", "issuing_authority")],
        "doc_number",
        "implement_date",
        "content",
        "raw_html",
        "attachments",
        "images",
    )
    return (
        items.join(doc, [*runs, "url"])
        .join(names, "source", "left")
        .select(
            *runs,
            "page_id",
            "pos",
            "source",
            first_nonblank(F.col("doc_title"), F.col("title")).alias("title"),
            F.col("url").alias("source_url"),
            "doc_number",
            first_nonblank(F.col("doc_issuing_authority"), F.col("source_name")).alias("issuing_authority"),
            first_nonblank(F.col("doc_publish_date"), F.col("date")).alias("publish_date"),
            "implement_date",
            "content",
            "raw_html",
            "attachments",
            "images",
        )
    )


def unread_items(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Items whose page is missing: the failed details of a run."""
    return items.join(documents.select("url"), "url", "left_anti")


# ---------------------------------------------------------------- containment of titles


def _positions(texts: DataFrame, widths: DataFrame) -> DataFrame:
    """(grp, id, k, p, gram): the grams of ``k`` characters at every place ``p`` of the texts, for the widths of their group."""
    # Positions carry a hash of their text, not the text, and are taken in windows of 1,024, then of 32
    # characters: a cut counts characters from the start of what it is made in, here never far away.
    rows = texts.join(widths, "grp")
    for size, name in ((1024, "v"), (32, "w")):
        window = F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / size).cast("int")))
        rows = rows.withColumn(name, window).withColumn("text", F.substr(F.col("text"), F.col(name) * size + 1, F.lit(size - 1) + F.col("k")))
        rows = rows.where(F.length("text") >= F.col("k"))
    last = F.least(F.lit(32), F.length("text") - F.col("k") + 1)
    rows = rows.where("w < 32").withColumn("i", F.explode(F.sequence(F.lit(1), last)))
    return rows.select(
        "grp", "id", "k", (F.col("v") * 1024 + F.col("w") * 32 + F.col("i")).alias("p"), F.substr("text", "i", "k").alias("gram")
    )


def _anchors(texts: DataFrame, widths: DataFrame) -> DataFrame:
    """(grp, id, k, p, h): the places a hash of their gram chooses, so that a text and what contains it choose alike.

    Titles no longer meet by these: see :mod:`edictum.operators.containment`.
    """
    hashed = _positions(texts, widths).select("grp", "id", "k", "p", F.xxhash64("gram").alias("h"))
    every = F.when(F.col("k") == _LONG[0], _LONG[1]).otherwise(_SHORT[1])
    return hashed.where(F.pmod("h", every) == 0)


def match_titles(items: DataFrame, documents: DataFrame) -> DataFrame:
    """First item of the same source whose title contains, or is contained in, each document's.

    Returns (url, source, title, item_page_id, item_pos, item_url, item_title) for the documents
    that have a match. "First" is by (page_id, pos).
    """
    # Only titles are compared, each once: staged, so that no step reads the documents again for them.
    sides = items.select(
        F.col("source").alias("grp"), trim_u(F.col("title")).alias("t"), F.struct("page_id", "pos", "url", "title").alias("item"), F.lit(False).alias("doc")
    ).unionByName(documents.select(F.col("source").alias("grp"), trim_u(F.col("title")).alias("t"), F.lit(True).alias("doc")), allowMissingColumns=True)
    order = F.when(F.col("item").isNotNull(), F.struct("item.page_id", "item.pos"))
    titles = stage(
        sides.where("grp IS NOT NULL AND t <> ''")
        .groupBy("grp", "t")
        .agg(F.min_by("item", order).alias("item"), F.max("doc").alias("doc"))
        .select("grp", "t", F.unhex(F.md5("t")).alias("key"), F.col("item").isNotNull().alias("listed"), "doc", "item.*")
    )
    place = ["grp", "key", "listed", "doc", "page_id", "pos"]
    shorter = titles.select("grp", F.col("key").alias("held"), *[F.col(c).alias(f"held_{c}") for c in place[2:]])

    def pair(when: Column, d: str, t: str, of: str) -> Column:
        at = F.struct(F.col(f"{of}page_id").alias("page_id"), F.col(f"{of}pos").alias("pos"))
        return F.when(when, F.struct(F.col(d).alias("d_key"), F.col(t).alias("t_key"), at.alias("at")))

    ways = F.array(pair(F.col("doc") & F.col("held_listed"), "key", "held", "held_"), pair(F.col("listed") & F.col("held_doc"), "held", "key", ""))
    pairs = held_texts(titles, place).join(shorter, ["grp", "held"]).select("grp", F.explode(F.array_compact(ways)).alias("p"))
    same = titles.where("doc AND listed").select("grp", F.col("key").alias("d_key"), F.col("key").alias("t_key"), F.struct("page_id", "pos").alias("at"))
    # Pairs are digests: titles come back only for the matches that are kept.
    first = stage(pairs.select("grp", "p.*").unionByName(same).groupBy("grp", "d_key").agg(F.min_by("t_key", "at").alias("t_key")))
    found = titles.where("listed").select(
        F.col("grp").alias("source"),
        F.col("key").alias("t_key"),
        F.col("page_id").alias("item_page_id"),
        F.col("pos").alias("item_pos"),
        F.col("url").alias("item_url"),
        F.col("title").alias("item_title"),
    )
    keyed = documents.select("url", "source", "title", F.unhex(F.md5(trim_u(F.col("title")))).alias("d_key"))
    return (
        keyed.join(first.withColumnRenamed("grp", "source"), ["source", "d_key"])
        .join(found, ["source", "t_key"])
        .select("url", "source", "title", "item_page_id", "item_pos", "item_url", "item_title")
    )


def link_by_title(items: DataFrame, documents: DataFrame, sources: DataFrame) -> DataFrame:
    """Policy rows of all items; the matched items of a source carry its document's fields.

    The issuing authority of the source's first document goes to all items of the source, its name
    where that is blank. Content, number and attachments go to every row with the matched URL.
    ``documents`` carries ``page_id`` to say which comes first.
    """
    # Which document a row takes is told by keys; contents are dealt out once, then met by the rows that take them.
    first = F.struct("page_id")
    places = documents.groupBy("source", "url").agg(F.min(first).alias("page"))
    taken = (
        match_titles(items, documents)
        .join(places, ["source", "url"])
        .groupBy("source", F.col("item_url").alias("url"))
        .agg(F.min(F.struct("page.page_id", F.col("url").alias("doc_url"))).alias("doc"))
        .select("source", "url", "doc.doc_url")
    )
    contents = (
        documents.select("source", F.concat(F.lit("="), "url").alias("doc_key"), "page_id", "doc_number", "content", "attachments")
        .repartition("source", "doc_key")
        .groupBy("source", "doc_key")
        .agg(F.min_by(F.struct("doc_number", "content", "attachments"), first).alias("doc"))
    )
    authority = documents.groupBy("source").agg(
        F.min_by("issuing_authority", F.struct("page_id", "url")).alias("doc_authority")
    )
    names = sources.select(F.col("id").alias("source"), F.col("name").alias("source_name"))
    no_links = F.from_json(F.lit("[]"), "array<struct<url:string>>")
    return (
        items.join(taken, ["source", "url"], "left")
        .join(authority.join(names, "source", "full"), "source", "left")
        # Rows without a document have a key of their own each: no task gets all of a source.
        .withColumn("doc_key", F.coalesce(F.concat(F.lit("="), "doc_url"), F.concat(F.lit("-"), "url")))
        .join(contents, ["source", "doc_key"], "left")
        .select(
            "page_id",
            "pos",
            "source",
            "title",
            F.col("url").alias("source_url"),
            F.col("date").alias("publish_date"),
            F.coalesce("doc.doc_number", F.lit("")).alias("doc_number"),
            first_nonblank(F.col("doc_authority"), F.col("source_name")).alias("issuing_authority"),
            F.coalesce("doc.content", F.lit("")).alias("content"),
            F.coalesce("doc.attachments", no_links).alias("attachments"),
        )
    )
