"""How sources of a language differ in their words: chunk factorization and smoothed, exact divergences."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edictum.llm.common import stage, unstage

#: Letters of ASCII and all characters beyond it.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LOWER_TERM = r"^[^\x00-\x60\x7B-\x7F]+$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
HELD = 500_000  # chunks a task counts before it passes them on


def _named(docs: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(blank("lang"), blank("source"), blank("text"))


CHUNKS = "lang string, source string, chunk binary, n bigint, docs bigint, first bigint, last bigint"
_CHUNKS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("chunk", pa.binary()), *[(c, pa.int64()) for c in ("n", "docs", "first", "last")]])


def chunk_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, chunk, n, docs, first, last): places and documents of each chunk between white space.

    ``first`` and ``last`` are two of those documents, so they are all of them where ``docs`` is one or
    two. Documents are rows, numbered by partition and place, so a task that runs again has to see its
    rows in the same order, as from a table. Chunks are counted per document; a task adds up to ``held``
    of them before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        tables: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
        entries = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), table in tables.items():
                n = len(table)
                numbers = np.array(list(table.values()), np.int64).reshape(n, 4)
                same = lambda value: pa.array([value]).take(pa.array(np.zeros(n, np.int32)))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([same(lang), same(source), pa.array(list(table), pa.binary()), *[pa.array(c) for c in numbers.T]], schema=_CHUNKS)

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                table = tables[lang, source]
                before = len(table)
                for chunk, n in Counter(text.split()).items():
                    entry = table.get(chunk)
                    if entry is None:
                        table[chunk] = [n, 1, row, row]
                    else:
                        entry[0] += n
                        entry[1] += 1
                        entry[3] = row
                entries += len(table) - before
                row += 1
                if entries >= held:
                    yield from counted()
                    tables.clear()
                    entries = 0
        yield from counted()

    rows = _named(docs).withColumn("text", F.col("text").cast("binary"))
    key = ["lang", "source", "chunk"]
    sums = rows.mapInArrow(run, CHUNKS).repartition(*key).groupBy(*key)
    sums = sums.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.min("first").alias("first"), F.max("last").alias("last"))
    return sums.withColumn("chunk", F.col("chunk").cast("string"))


def chunk_terms(chunks: DataFrame) -> DataFrame:
    """(t_chunk, term): the terms of each different chunk, A-Z in lower case, as often as they stand in it."""
    terms = F.regexp_extract_all(F.translate("chunk", _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    return chunks.select("chunk").distinct().select(F.col("chunk").alias("t_chunk"), F.explode(terms).alias("term"))


def term_counts(counts: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) from chunk counts; ``docs`` is 1, 2, or more for more than two.

    A chunk that is a term already stands for itself; the others are tokenized once each and meet their
    terms by a join. A term is in more than two documents if one of its chunks is, or if more than two are
    named as ``first`` or ``last``. The latter shows without keeping them: of two documents, the common
    bits of any number of their 128-bit digests are those of the smallest and the largest one.
    """
    known = F.regexp_like("chunk", F.lit(LOWER_TERM))
    rest = counts.where(~known).repartition("chunk")
    found = rest.join(chunk_terms(rest).hint("shuffle_hash"), F.col("chunk") == F.col("t_chunk"))
    thin = ["lang", "source", "term", "n", "docs", "first", "last"]
    each = counts.where(known).withColumn("term", F.col("chunk")).select(*thin).unionByName(found.select(*thin))
    digests = {k: lambda c, k=k: F.xxhash64(F.lit(k), F.col(c)) for k in (1, 2)}
    masks = [f(d("first").bitwiseOR(d("last")) if name == "any" else d("first").bitwiseAND(d("last"))).alias(f"{name}{k}")
             for k, d in digests.items() for name, f in (("any", F.bit_or), ("all", F.bit_and))]
    sums = each.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.max("docs").alias("most"), F.min("first").alias("first"), F.max("last").alias("last"), *masks
    )
    two = F.lit(True)
    for k, d in digests.items():
        two &= (F.col(f"any{k}") == d("first").bitwiseOR(d("last"))) & (F.col(f"all{k}") == d("first").bitwiseAND(d("last")))
    docs = F.when(F.col("most") > 2, F.col("most")).when(F.col("first") == F.col("last"), F.lit(1)).when(two, F.lit(2)).otherwise(F.lit(3))
    return sums.select("lang", "source", "term", "n", docs.cast("bigint").alias("docs"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + 1) / (total + terms)), in decimals so that no count overflows; 1 without terms."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(1)).cast("decimal(19,0)")
    whole = F.nullif(total + terms, F.lit(0)).cast("decimal(19,0)")
    return F.coalesce(F.call_function("div", wide, whole), F.lit(0)) + F.lit(1)


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """Term counts of a corpus by language and source, staged, and the divergences they give.

    ``groups``: (lang, source, total, terms, own, p0), one row per occurring pair, without terms too:
    places of kept terms there, kept terms of the language, how many occur here, share of one that does not.
    ``kept``: (lang, source, term, n, p, q, p0) for kept terms that occur: share here and in the language.
    """

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        counts = stage(chunk_counts(docs), "chunks")
        terms = stage(term_counts(counts), "terms")
        unstage(counts)
        one = Window.partitionBy("lang", "term")
        first = F.row_number().over(one.orderBy("source")) == 1
        marked = terms.select("lang", "source", "term", "n", F.sum("n").over(one).alias("all"), F.sum("docs").over(one).alias("docs"), first.alias("one"))
        kept = stage(marked.where(F.col("docs") >= least_docs).drop("docs"), "kept")
        unstage(terms)
        once = F.when(F.col("one"), F.col("all")).otherwise(F.lit(0))
        langs = kept.groupBy(F.col("lang").alias("l_lang")).agg(F.count_if("one").alias("terms"), F.sum(once).alias("lang_total"))
        own = kept.groupBy(F.col("lang").alias("o_lang"), F.col("source").alias("o_source")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
        groups = _named(docs).select("lang", "source").distinct()
        groups = groups.join(langs, F.col("lang") == F.col("l_lang"), "left")
        groups = groups.join(own, (F.col("lang") == F.col("o_lang")) & (F.col("source") == F.col("o_source")), "left")
        none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
        groups = groups.select("lang", "source", none("total"), none("terms"), none("own"), none("lang_total"))
        self.groups = stage(groups.withColumn("p0", _share(F.lit(0), F.col("total"), F.col("terms"))), "groups")
        g = self.groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "total", "terms", "lang_total", "p0")
        kept = kept.join(g, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")))
        p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("all"), F.col("lang_total"), F.col("terms"))
        self.kept = stage(kept.select("lang", "source", "term", "n", p.alias("p"), q.alias("q"), "p0"), "shares")

    def terms(self, top: int = TOP) -> DataFrame:
        """(lang, source, item, value, rank): the terms a source has more of than its language, the most telling first."""
        over = self.kept.where("p > q").select("lang", "source", F.col("term").alias("item"), _excess(F.col("p"), F.col("q")).alias("value"))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
        return over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    def pairs(self) -> DataFrame:
        """(lang, source, item, value, rank): how far each other source of the language is from a source.

        The sum over all kept terms falls apart by where a term occurs: in neither source, in one, in
        both. Terms of one source only need its count, so sources meet as histograms of counts; terms
        of both are brought together term by term, as many times as sources share one.
        """
        side = lambda k: self.groups.select(*[F.col(c).alias(f"{c}{k}") for c in ("lang", "source", "terms", "own", "p0")])
        two = side(1).join(side(2), (F.col("lang1") == F.col("lang2")) & (F.col("source1") != F.col("source2")))
        neither = two.select(F.col("lang1").alias("lang"), F.col("source1").alias("source"), F.col("source2").alias("item"),
                             ((F.col("terms1") - F.col("own1") - F.col("own2")) * _excess(F.col("p01"), F.col("p02"))).alias("value"))
        level = stage(self.kept.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"), F.first("p0").alias("own_p0")), "levels")
        other = self.groups.select(F.col("lang").alias("o_lang"), F.col("source").alias("o_source"), F.col("p0").alias("o_p0"))
        met = level.join(other, (F.col("lang") == F.col("o_lang")) & (F.col("source") != F.col("o_source")))
        mine = met.select("lang", "source", F.col("o_source").alias("item"), (F.col("m") * _excess(F.col("p"), F.col("o_p0"))).alias("value"))
        theirs = met.select("lang", F.col("o_source").alias("source"), F.col("source").alias("item"), (F.col("m") * _excess(F.col("o_p0"), F.col("p"))).alias("value"))
        a = self.kept.select("lang", "term", F.col("source").alias("s"), F.col("p").alias("ps"), F.col("p0").alias("s0"))
        b = self.kept.select(F.col("lang").alias("b_lang"), F.col("term").alias("b_term"), F.col("source").alias("t"), F.col("p").alias("pt"), F.col("p0").alias("t0"))
        both = a.join(b, (F.col("lang") == F.col("b_lang")) & (F.col("term") == F.col("b_term")) & (F.col("s") < F.col("t")))
        ps, pt, s0, t0 = (F.col(c) for c in ("ps", "pt", "s0", "t0"))
        shared = both.groupBy("lang", "s", "t").agg(
            F.sum(_excess(ps, pt) - _excess(ps, t0) - _excess(s0, pt) + _excess(s0, t0)).alias("there"),
            F.sum(_excess(pt, ps) - _excess(pt, s0) - _excess(t0, ps) + _excess(t0, s0)).alias("back"),
        )
        ways = F.array(F.struct(F.col("s").alias("source"), F.col("t").alias("item"), F.col("there").alias("value")),
                       F.struct(F.col("t").alias("source"), F.col("s").alias("item"), F.col("back").alias("value")))
        parts = neither.unionByName(mine).unionByName(theirs).unionByName(shared.select("lang", F.inline(ways)))
        sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
        return sums.withColumn("rank", F.row_number().over(order))


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) by the contract: part ``pair`` and part ``term``.

    NULL text, lang or source is blank. Each row is a document. A language without kept terms has pairs
    of value 0; a source alone in its language has none. Equal values are ranked by item. An empty
    table gives no rows; further columns are ignored.
    """
    audit = Audit(docs, least_docs)
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank"))
    return part(audit.pairs(), "pair").unionByName(part(audit.terms(top), "term"))
