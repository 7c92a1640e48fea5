"""Substring dedup: content-defined chunks by a gear rolling hash, found again by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edictum.llm.common import stage, table, utf8

# The cut rule looks at bits 9 to 12 of the hash: they depend on the last 13 bytes, and one place in 16 is a cut.
CUT_BITS = 0x1E00
LEAST_GAP = 8
LONGEST = 256
SHARE = 1024  # a digest with more than one in so many of the repeated chunks is dealt out
LEAST_WORDS = 20  # words of a repeated passage that whole chunks must cover


def gear_table() -> np.ndarray:
    """256 numbers of 16 bits, from a hash of the byte."""
    import xxhash

    return np.array([xxhash.xxh32_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)], np.uint16)


GEAR = gear_table()
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h = 2 h + gear[byte] modulo 2^16 after every byte, by doubling the window four times."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        if len(h) > step:
            wider = h.copy()
            wider[step:] += h[:-step] << np.uint16(step)
            h = wider
    return h


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text. A cut depends on the bytes just before it, so an insertion moves few.

    Cuts less than eight bytes after another, or inside a character, do not count; a chunk longer
    than 256 bytes is cut every 256 from its start.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.flatnonzero((gear_hashes(data) & np.uint16(CUT_BITS)) == 0) + 1
    ends = ends[ends < n]
    ends = ends[(data[ends] & 0xC0) != 0x80]
    if len(ends):
        ends = ends[np.r_[ends[0] >= LEAST_GAP, np.diff(ends) >= LEAST_GAP]]
    ends = np.r_[ends, n]
    starts = np.r_[0, ends[:-1]]
    more = (ends - starts - 1) // LONGEST
    if not more.any():
        return ends
    owner = np.repeat(np.arange(len(ends)), more + 1)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1) + 1
    return np.minimum(starts[owner] + LONGEST * nth, ends[owner])


_CHUNKS = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("place", pa.int64())])


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, place) of all chunks of whole texts.

    ``place`` packs the first byte, the size and the words that begin in the chunk: first * 2^20 +
    size * 2^9 + words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            owner, digests, places = [], [], []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                data = np.frombuffer(text, np.uint8)
                if not len(data):
                    continue
                ends = cuts(data)
                starts = np.r_[0, ends[:-1]]
                blank = _BLANK[data]
                begins = ~blank
                begins[1:] &= blank[:-1]
                words = np.add.reduceat(begins, starts, dtype=np.int64)
                digests += [digest(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                places.append(starts << 20 | (ends - starts) << 9 | words)
                owner.append(np.full(len(ends), doc_id, np.int64))
            if digests:
                columns = {"doc_id": np.concatenate(owner), "digest": np.array(digests, np.uint64).view(np.int64), "place": np.concatenate(places)}
                yield table(columns, _CHUNKS)

    named = docs.where("doc_id IS NOT NULL")
    rows = named.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, digest bigint, place bigint")


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, first_byte, end_byte, words, n_chunks, kept_in): passages that a smaller doc_id has too.

    A chunk is repeated where its digest occurs in a document of a smaller id; the smallest keeps it.
    Neighbouring repeated chunks are one passage, reported if at least ``least_words`` words begin
    in it. Whole chunks alone count, so the stretch before the first and after the last cut of a copied
    passage stays outside: some 4 words at either end. Digests have 64 bits; one that agrees by chance
    can lengthen a passage by a chunk but not make one.

    Digests are counted before anything is joined, added up in each task first, and only chunks that do
    repeat go on. A digest with more than one of ``SHARE`` of them is dealt over as many tasks as it holds
    shares, and only its one row of owners is copied, as often. Documents without an id can be neither
    named nor kept and are left out; so are repeated rows of one document, and NULL or empty texts have
    no chunks.
    """
    pieces = chunks(docs)
    counted = pieces.groupBy("digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    owners = stage(counted.where("owner < last").select(F.col("digest").alias("o_digest"), "owner", "n"), "owners")
    total = owners.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = max(total // SHARE, 1)
    parts = F.when(F.col("n") > share, F.ceil(F.col("n") / share)).otherwise(1).cast("int")
    hot = owners.where(F.col("n") > share).select(F.col("o_digest").alias("h_digest"), parts.alias("parts"))  # fewer than SHARE
    dealt = pieces.join(F.broadcast(hot), F.col("digest") == F.col("h_digest"), "left")
    dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc_id", "place"), "parts"), F.lit(0)).cast("int"))
    copies = owners.select("o_digest", "owner", F.explode(F.sequence(F.lit(0), parts - 1)).alias("o_part"))
    same = (F.col("digest") == F.col("o_digest")) & (F.col("part") == F.col("o_part"))
    again = dealt.join(copies, same & (F.col("doc_id") > F.col("owner")))
    again = again.select("doc_id", "place", "owner").repartition("doc_id").groupBy("doc_id", "place").agg(F.min("owner").alias("owner"))
    first = F.shiftright("place", 20)
    size = F.shiftright("place", 9).bitwiseAND(F.lit(0x7FF))
    spans = again.select("doc_id", "owner", first.alias("a"), (first + size).alias("b"), F.col("place").bitwiseAND(F.lit(0x1FF)).alias("words"))
    order = Window.partitionBy("doc_id").orderBy("a")
    starts = (F.col("a") != F.coalesce(F.lag("b").over(order), F.lit(-1))).cast("int")
    runs = spans.withColumn("starts", starts).withColumn("run", F.sum("starts").over(order))
    found = runs.groupBy("doc_id", "run").agg(
        F.min("a").alias("first_byte"), F.max("b").alias("end_byte"), F.sum("words").alias("words"),
        F.count(F.lit(1)).alias("n_chunks"), F.sort_array(F.collect_set("owner")).alias("kept_in"),
    )
    return found.where(F.col("words") >= least_words).drop("run")


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents with repeated passages cut out of their texts, all columns as they were."""
    spans = repeated_passages(docs, least_words).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.sort_array(F.collect_list(F.struct("first_byte", "end_byte"))).alias("_spans")
    )
    joined = docs.join(spans, F.col("doc_id") == F.col("_doc"), "left").drop("_doc")
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if spans:
                    data, out, at = text.encode(), [], 0
                    for span in spans:
                        out.append(data[at : span["first_byte"]])
                        at = span["end_byte"]
                    text = b"".join([*out, data[at:]]).decode(errors="ignore")
                texts.append(text)
            columns = [pa.array(texts, f.type) if i == place else batch.column(i) for i, f in enumerate(batch.schema)]
            yield pa.RecordBatch.from_arrays(columns[:-1], schema=pa.schema(list(batch.schema)[:-1]))

    return joined.mapInArrow(run, docs.schema)
