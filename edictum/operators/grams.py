"""Keyword search over a stored policy table by an inverted index of character grams.

The index says which files of the table hold a gram. A keyword is cut into grams, the files that hold
all of them are candidates, and only those are read and searched; so a rare word of a large table
costs a lookup and a few files. Files are read and indexed once: new ones are added to the index, and
postings of files that are gone are never asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edictum import schemas
from edictum.operators.search import search
from edictum.sources.tables import empty, path_exists

GRAM = 3
SEARCHED = ("title", "content", "doc_number")
POSTINGS, FILES = "gram string, file string", "file string"
BLOCK = 1 << 20  # characters whose grams are made distinct at a time
CASELESS = "[0-9\u3000-\u303f\u4e00-\u9fff]+"  # of what folding case neither changes nor makes


def grams(text: Column) -> Column:
    """All stretches of three characters, in lower case, as the keyword filter folds it; none begins within a character."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?s)(?![\x{DC00}-\x{DFFF}])(?=(" + "." * GRAM + "))"), F.lit(1))


def gram_rows(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(file, gram) of rows with a file and the searched columns: those of :func:`grams`, repeats within a block left out.

    Three characters of 21 bits are one number, so a block is a few passes over arrays and no text is cut out
    but those of the different grams. A long text goes in pieces that overlap by what a gram needs.
    """
    bits, gap = 21, 0xD800  # between two texts stands what no text holds

    def pieces_of(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
        files, *columns = (c.to_pylist() for c in batch.columns)
        for file, *row in zip(files, *columns, strict=True):
            for text in row:
                for k in range(0, len(text or "") - GRAM + 1, block):
                    yield file, text[k : k + block + GRAM - 1]

    def distinct(some: list[str]) -> list[str]:
        codes = np.frombuffer(chr(gap).join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        keys = np.zeros(len(codes) - GRAM + 1, np.uint64)
        for k in range(GRAM):
            keys = keys << np.uint64(bits) | codes[k : len(codes) - GRAM + 1 + k]
        keys = pa.array(keys).unique().to_numpy()
        parts = np.stack([keys >> np.uint64(bits * (GRAM - 1 - k)) & np.uint64((1 << bits) - 1) for k in range(GRAM)], axis=1)
        parts = parts[(parts != gap).all(axis=1)]
        text = parts.astype(np.uint32).tobytes().decode("utf-32-le")
        return [text[k : k + GRAM] for k in range(0, len(text), GRAM)]

    def batch_of(file: str, some: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file], pa.string()), pa.array([distinct(some)], pa.list_(pa.string()))], ["file", "grams"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, some, size = None, [], 0
        for batch in batches:
            for file, piece in pieces_of(batch):
                if some and (file != at or size >= block):
                    yield batch_of(at, some)
                    some, size = [], 0
                at = file
                some.append(piece)
                size += len(piece)
        if some:
            yield batch_of(at, some)

    blocks = texts.select("file", *[F.lower(F.col(c)).alias(c) for c in SEARCHED]).mapInArrow(run, "file string, grams array<string>")
    return blocks.select("file", F.explode("grams").alias("gram"))


def update_index(table: DataFrame, path: str) -> int:
    """Add the files of a stored table that the index at ``path`` does not know; returns how many.

    Only the new files are opened for their texts. Grams of a file are made distinct in the task that reads it
    and once more after the shuffle. Postings are sorted by gram, so that a lookup reads few of them. Files are
    marked as known last: an update that ends early is done again, and doubled postings do no harm.
    """
    spark = table.sparkSession
    file = F.col("_metadata.file_path")
    known = read_files(spark, path)
    names = table.select(file.alias("file")).distinct().join(F.broadcast(known.withColumnRenamed("file", "known")), F.col("file") == F.col("known"), "left_anti")
    added = [r.file for r in names.collect()]
    if not added:
        return 0
    each = gram_rows(table.where(file.isin(added)).select(file.alias("file"), *SEARCHED))
    postings = each.groupBy("gram", "file").agg(F.count(F.lit(1)).alias("rows")).select("gram", "file")
    postings.repartitionByRange("gram").sortWithinPartitions("gram", "file").write.mode("append").parquet(f"{path}/postings")
    spark.createDataFrame([(a,) for a in added], FILES).coalesce(1).write.mode("append").parquet(f"{path}/files")
    return len(added)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    at = f"{path}/files"
    return spark.read.schema(FILES).parquet(at) if path_exists(spark, at) else empty(spark, FILES)


def pieces(keyword: str) -> list[str]:
    """The literal parts of a keyword, between its wildcards."""
    return [p for p in re.split("[%_]", keyword) if p]


def caseless_part(keyword: str) -> str:
    """The longest stretch of a keyword that a text must hold as it stands, whatever the case of the rest."""
    return max(re.findall(CASELESS, keyword), key=len, default="")


def candidate_files(spark: SparkSession, path: str, keyword: str) -> DataFrame | None:
    """(file) of the files that hold all grams of a keyword; None where it has no gram, so that all do."""
    texts = spark.createDataFrame([(p,) for p in pieces(keyword)], "piece string")
    wanted = [r.gram for r in texts.select(F.explode(grams(F.col("piece"))).alias("gram")).distinct().collect()]
    if not wanted:
        return None
    if not path_exists(spark, f"{path}/postings"):
        return empty(spark, FILES)
    found = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("gram").isin(wanted)).distinct()
    return found.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted)).select("file")


def search_stored(table: DataFrame, path: str, keyword: str, **filters: str) -> DataFrame:
    """Policies of a stored table that pass a keyword and other filters, by the index at ``path``.

    Rows are those of :func:`search.search`. Files that the index does not know are read as well, so a
    table that has grown since loses nothing. The names of the files to read come to the driver, as they
    do when a table is opened. Where the keyword has digits or Chinese characters, only texts that hold them
    are folded and matched.
    """
    spark, keyword = table.sparkSession, (keyword or "").strip()
    found = candidate_files(spark, path, keyword) if keyword else None
    if found is None:
        return search(table, keyword=keyword, **filters)
    wanted = {_plain(r.file) for r in found.collect()}
    known = {_plain(r.file) for r in read_files(spark, path).collect()}
    names = [f for f in table.inputFiles() if _plain(f) in wanted or _plain(f) not in known]
    rows = spark.read.schema(table.schema).parquet(*names) if names else spark.createDataFrame([], table.schema)
    if part := caseless_part(keyword):
        rows = rows.where(reduce(Column.__or__, [F.contains(F.col(c), F.lit(part)) for c in SEARCHED]))
    return search(rows, keyword=keyword, **filters)


def _plain(name: str) -> str:
    """A file name with three slashes after the scheme of local files, where Spark writes one or three."""
    return re.sub("^file:/+", "file:///", name)
