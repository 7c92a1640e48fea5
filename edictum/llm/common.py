"""What the operators of this subpackage share: session, staging, text normal forms, bounded samples."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edictum.session import configure, shared_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Rows of a batch handed to Python: bounds what a worker holds when texts are long.
BATCH_ROWS = 256
BATCH_BYTES = 32 << 20
MOST_GROUPS = 10_000


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; Python workers find this package where the driver found it."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    paths = spark.sparkContext.environment
    known = paths.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(p for p in (known, ROOT) if p)
    return spark


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a result that is read more than once as Parquet into the shared folder, and read it back.

    The folder goes away with the application. A lost executor costs no more than a new read.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    # What the write shuffled is not read again: its files go when it ends.
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def unstage(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_at)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % modulus


def held(key: str, modulus: int, rest: int) -> Column:
    """Whether a document is kept from learning; one without an id is not."""
    return F.coalesce(remainder(key, modulus) == rest, F.lit(False))


def utf8(column: str = "text") -> Column:
    """A text as UTF-8 bytes; NULL as no bytes."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def bounded_sample(df: DataFrame, by: str | None, key: str, k: int, seed: int = 17) -> DataFrame:
    """About the ``k`` rows of each value of ``by`` whose hashed ``key`` is smallest, never more than ``2 k``.

    Counts come first, so a map task only passes rows below a threshold that fits its group: what
    meets in a task is about ``k`` rows however large the group is. Rows equal in ``key`` go in or
    stay out together up to the bound. Rows with a NULL group are left out; without ``by`` all rows
    are one group. More than ten thousand groups are refused, so the counts can be broadcast.
    """
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(1.25 * k + 8)
    if by is None:
        near = df.withColumn("_spot", spot).where(F.col("_spot") * F.lit(df.count()) <= share)
        return near.orderBy("_spot", key).limit(2 * k).drop("_spot")
    rows = df.where(F.col(by).isNotNull())
    counts = rows.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.limit(MOST_GROUPS + 1).collect()
    if len(found) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} different values of {by} to sample from")
    counts = df.sparkSession.createDataFrame(found, counts.schema)
    near = rows.join(F.broadcast(counts), F.col(by) == F.col("_by")).withColumn("_spot", spot)
    near = near.where(F.col("_spot") * F.col("_n") <= share)
    first = Window.partitionBy("_by").orderBy("_spot", key)
    return near.withColumn("_i", F.row_number().over(first)).where(F.col("_i") <= 2 * k).drop("_by", "_n", "_spot", "_i")


def table(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of a partition sorted by ``keys``, one group after the other, never more than a batch at a time.

    A group's rows must be taken before the next group is asked for; what is left is skipped.
    """
    rows = (row for batch in batches for row in batch.to_pylist())
    pending = next(rows, None)
    while pending is not None:
        key = tuple(pending[k] for k in keys)

        def group() -> Iterator[dict]:
            nonlocal pending
            while pending is not None and tuple(pending[k] for k in keys) == key:
                row, pending = pending, None
                pending = next(rows, None)
                yield row

        members = group()
        yield key, members
        for _ in members:
            pass


def fold_table(kept) -> bytes:
    """A table for ``bytes.translate``: A-Z to lower case, what ``kept`` refuses to a blank."""
    out = bytearray(range(256))
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        out[b] = low if kept(low) else 32
    return bytes(out)


#: Letters and digits of ASCII and all bytes of longer UTF-8 sequences; the rest separates words.
WORD_BYTES = fold_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def byte_letters() -> dict[str, int]:
    """The character byte-level vocabularies write for each byte: printable ones as they are, others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
