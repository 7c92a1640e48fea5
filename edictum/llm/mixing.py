"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edictum.functions.names import fresh
from edictum.llm.common import stage
from edictum.operators.numbering import number_rows

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def text_size(text: str = "text") -> Column:
    """Words between ASCII white space; NULL counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources by code point, NULL last, take the weights in turn and share ``share`` of all sizes. A
    target stops at ``most`` times its source's size and the excess is shared anew by weight. That
    ends where every source has the smaller of its bound and one common level times its weight, so
    the level is read off the sources in order of bound / weight. Rows here are one per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = len(weights)
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % n
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    bound = F.col("source_size").cast("double") * F.lit(most)
    ranked = per_source.withColumn("w", weight).withColumn("bound", bound)
    order = Window.orderBy(F.col("bound") / F.col("w"), F.col("source").asc_nulls_last())
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (
        F.sum("source_size").over(whole).cast("double") * F.lit(share)
        - F.coalesce(F.sum("source_size").over(earlier), F.lit(0)).cast("double") * F.lit(most)
    ) / F.sum("w").over(later)
    # The first source whose own bound is not under the level sets it for itself and all after it.
    ranked = ranked.withColumn("level", level).withColumn("open", F.col("bound") >= F.col("level") * F.col("w"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("bound") / F.col("w"), F.col("level")))).over(whole)
    common = first.getField("level")
    target = F.when(common.isNull(), F.col("bound")).otherwise(F.least(F.col("bound"), common * F.col("w")))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The place of each document in the mix: (doc_id, source, size, source_size, target, rows, before, ratio, offset).

    Within a source the documents stand in order of size, then of md5 of their id, then id. Each
    expects target / source_size copies; the running sum plus one offset per source, derived from
    the seed and the source's name, gives a copy for every integer it passes. Order by size makes
    the words taken follow the target closely.

    The running sum is a rank times a constant. Ranks are added up over sizes, over 4096 slices of
    the md5 and within a slice, so no source and no size is ever sorted in one task. Rows that agree
    in id, source and size are counted before they are ranked: ``rows`` of them have the ranks after
    ``before``, one each, and :func:`copies` says how often each is taken. NULL ids stand first
    within their size; a NULL text has size 0; an empty table gives an empty result.
    """
    thin = docs.select("doc_id", "source", text_size().alias("size"))
    units = thin.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    targets = source_targets(
        units.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, share, most
    )
    digest = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    units = units.withColumn("digest", digest).withColumn("slice", F.substring("digest", 1, 3))

    slices = units.groupBy("source", "size", "slice").agg(F.sum("rows").alias("n"))
    before = (Window.unboundedPreceding, -1)
    in_size = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(*before)
    in_source = Window.partitionBy("source").orderBy("size").rowsBetween(*before)
    totals = slices.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = totals.select(
        F.col("source").alias("t_source"), F.col("size").alias("t_size"),
        F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("before_size"),
    )
    slices = slices.withColumn("before_slice", F.coalesce(F.sum("n").over(in_size), F.lit(0)))
    offsets = slices.join(
        totals, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("size") == F.col("t_size"))
    ).select(
        F.col("source").alias("o_source"), F.col("size").alias("o_size"), F.col("slice").alias("o_slice"),
        (F.col("before_size") + F.col("before_slice")).alias("earlier"),
    )
    in_slice = Window.partitionBy("source", "size", "slice").orderBy("digest", "doc_id").rowsBetween(*before)
    ranked = units.withColumn("inside", F.coalesce(F.sum("rows").over(in_slice), F.lit(0))).join(
        offsets,
        F.col("source").eqNullSafe(F.col("o_source"))
        & (F.col("size") == F.col("o_size"))
        & (F.col("slice") == F.col("o_slice")),
    )
    targets = targets.withColumnRenamed("source", "s_source")
    placed = ranked.join(targets, F.col("source").eqNullSafe(F.col("s_source")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "rows", (F.col("earlier") + F.col("inside")).alias("before"),
        ratio.alias("ratio"), offset_of(F.col("source"), seed).alias("offset"),
    )


def copies(before: Column, nth: Column | int, ratio: Column, offset: Column, most: float = MOST) -> Column:
    """How often the ``nth`` document after ``before`` others is taken: the integers its share of the running sum passes."""
    rank = before + nth
    passed = F.floor(ratio * rank + offset) - F.floor(ratio * (rank - 1) + offset)
    return F.least(passed, F.ceil(F.lit(most))).cast("int")


def offset_of(source: Column, seed: str) -> Column:
    """A number in [0, 1) from the seed and the source's name; NULL has its own."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, columns unchanged.

    The decision is joined back by id, source and size, NULLs included. Of rows that agree in these, each
    has a rank of its own, in order of their texts' hashes; they are numbered without bringing them
    together. Extra columns stay, whatever their names.
    """
    most = options.get("most", MOST)
    size, doc, source, words, times, place, nth = fresh(docs, "m_size", "m_doc", "m_source", "m_words", "m_times", "m_place", "m_nth")
    plan = stage(mix(docs, **options), "mix")
    decided = plan.select(
        F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("size").alias(words),
        F.when(F.col("rows") == 1, copies(F.col("before"), 1, F.col("ratio"), F.col("offset"), most)).alias(times),
    )
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(size) == F.col(words))
    sized = docs.withColumn(size, text_size())
    # The plan has a row for every document: both sides are dealt out, at every size alike.
    out = sized.join(decided.where(F.col(times) > 0).hint("merge"), same).select(*docs.columns, times)
    repeated = plan.where("rows > 1")
    if not repeated.isEmpty():
        keys = repeated.select(F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("size").alias(words))
        alike = sized.join(keys, same).withColumn(place, F.struct(F.xxhash64(F.col("text").cast("string")), F.monotonically_increasing_id()))
        alike = number_rows(alike.select(*docs.columns, doc, source, words, place), place, groups=[doc, source, words], out=nth)
        ranks = repeated.select(F.col("doc_id").alias("r_doc"), F.col("source").alias("r_source"), F.col("size").alias("r_size"), "before", "ratio", "offset")
        ranks = ranks.select(F.struct("r_doc", "r_source", "r_size").alias(size), F.struct("before", "ratio", "offset").alias(times))
        ranked = alike.join(ranks, F.struct(doc, source, words).eqNullSafe(F.col(size)))
        taken = copies(F.col(times)["before"], F.col(nth), F.col(times)["ratio"], F.col(times)["offset"], most)
        out = out.unionByName(ranked.select(*docs.columns, taken.alias(times)).where(F.col(times) > 0))
    return out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted), copies."""
    block = 4096
    plan = mix(docs, **options)
    last = F.floor((F.col("rows") - 1) / F.lit(block)).cast("int")
    blocks = plan.withColumn("block", F.explode(F.sequence(F.lit(0), last)))
    inside = F.least(F.col("rows") - F.col("block") * F.lit(block).cast("bigint"), F.lit(block)).cast("int")
    nth = F.col("block") * F.lit(block).cast("bigint") + F.col("inside")
    rows = blocks.withColumn("inside", F.explode(F.sequence(F.lit(1), inside)))
    rows = rows.withColumn("copies", copies(F.col("before"), nth, F.col("ratio"), F.col("offset"), options.get("most", MOST)))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
