"""Tables as files: pages, policies, logs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edictum import schemas
from edictum.session import stage

NAMED = {
    "policies": schemas.POLICIES,
    "crawler_logs": schemas.CRAWLER_LOGS,
    "attachment_text": schemas.ATTACHMENT_TEXT,
}

GROUP_BYTES = 32 << 20  # of a row group: what a lookup reads at least


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def commit_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all; False, and nothing done, if there is one of that name.

    It is written under a hidden name and then renamed without overwriting, which of two writers only one can do.
    """
    fs, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    target = fs.Path(path)
    hidden = fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    out = files.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    plain = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        fs.FileContext.getFileContext(target.toUri(), conf).rename(hidden, target, plain)
    except Exception as e:
        files.delete(hidden, False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table; with a schema given, a path that does not exist or has no files yet is an empty table."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else empty(spark, schema)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before work that costs more than moving them.

    Only a table that Spark reads in fewer tasks than there are cores is moved. Spark splits files
    by ``spark.sql.files.maxPartitionBytes``, so such a table is at most that size times the cores;
    a larger one stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """Write the engine's tables as empty files where they are missing; returns what was made."""
    made = []
    for name, schema in NAMED.items():
        path = f"{root}/{name}"
        if not path_exists(spark, path):
            empty(spark, schema).write.parquet(path)
            made.append(name)
    return made


def read_saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved HTML files as (url, html), one row per file; undecodable bytes are replaced.

    A path with no files gives no rows.
    """
    if not path_exists(spark, path):
        return empty(spark, "url string, html string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("url"), decode_text(F.col("content")).alias("html"))


def decode_text(content: Column) -> Column:
    """UTF-8 text of bytes; what is not UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def append_log(log: DataFrame, path: str) -> None:
    """Append run-log rows, numbered after those that are there, in order of start and name.

    A run writes a few rows. The ids are taken first, by creating a file named after the first of them;
    a writer that comes second sees it and takes the next ones, so several runs may append at once.
    """
    spark = log.sparkSession
    columns = [c for c in empty(spark, schemas.CRAWLER_LOGS).columns if c != "id"]
    rows = stage(log.select(*columns))
    n = rows.count()
    if not n:
        return
    taken = f"{path}/_ids"
    while True:
        top = read_table(spark, path, schemas.CRAWLER_LOGS).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        if path_exists(spark, taken):
            top = max([top, *[int(r[0]) for r in spark.read.text(f"{taken}/*").collect()]])
        if commit_file(spark, f"{taken}/{top + 1:012d}", str(top + n)):
            break
    place = F.row_number().over(Window.orderBy("start_time", "task_name"))
    numbered = rows.select((F.lit(top) + place).cast("bigint").alias("id"), *columns)
    # Two writers of one folder would clear each other's work: the rows get a hidden one, then the file moves.
    own = f"{path}/_runs/{top + 1:012d}"
    numbered.coalesce(1).write.parquet(own)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{own}/part-*")):
        files.rename(part.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"part-{top + 1:012d}.parquet"))


def write_policies(policies: DataFrame, path: str, lookups: tuple[str, ...] = ("source_url", "id"), group_bytes: int = GROUP_BYTES) -> None:
    """Write a snapshot of the policy table, clustered by month so that date ranges skip files.

    Each row group carries a bloom filter for the columns of ``lookups``, sized by what it holds: one URL or
    id is looked for in the few groups that may have it, and the rest of the table is not read.
    """
    month = F.date_trunc("month", F.col("publish_date"))
    dealt = policies.repartitionByRange(month, F.xxhash64("source_url")).sortWithinPartitions(month, "source_url")
    writer = dealt.write.mode("overwrite").option("parquet.block.size", group_bytes).option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def write_bucketed(policies: DataFrame, name: str, path: str, buckets: int, key: str = "source_url") -> DataFrame:
    """Write the policy table in buckets of its key, as a table of the catalog, and read it back.

    A merge then deals out only the batch: stored rows meet its keys bucket by bucket, in place. With as
    many buckets as shuffles have partitions, or more.
    """
    dealt = policies.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return policies.sparkSession.table(name)


def append_requests(log: DataFrame, path: str) -> None:
    """Append to the request log, stored by day: old days go by dropping their folder."""
    log.withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str = "policies", **options: str) -> DataFrame:
    """Policies kept in a database; needs its driver on the classpath.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read in parallel.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_jdbc(df: DataFrame, url: str, table: str = "policies", mode: str = "append", **options: str) -> None:
    """Export to a database; nested columns go as JSON text."""
    flat = df.select(
        *[
            F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c)
            for c, t in df.dtypes
        ]
    )
    flat.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def write_items_tsv(items: DataFrame, path: str) -> None:
    """date, title, url per line, tab-separated."""
    items.select("date", "title", "url").write.mode("overwrite").option("sep", "\t").csv(path)
