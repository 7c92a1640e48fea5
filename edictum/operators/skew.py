"""Lookups whose big side may hold most of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.functions.names import fresh
from edictum.session import stage

SHARE = 1024  # a key with more than one row in so many is hot


def hot_keys(rows: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """(hot, parts): the keys that hold more than one of ``share`` rows, with how many shares they hold.

    Rows are counted per key, added up before the shuffle; keys of one row are kept as one sum. There are
    fewer than ``share`` such keys.
    """
    each = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("hot")).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(each.groupBy(F.when(F.col("n") > 1, F.col("hot")).alias("hot")).agg(F.sum("n").alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("decimal(38,0)")).scalar()
    own = F.col("n").cast("decimal(38,0)") * F.lit(share)
    return counts.where(F.col("hot").isNotNull() & (own > total)).select("hot", F.ceil(own / total).cast("int").alias("parts"))


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left", share: int = SHARE) -> DataFrame:
    """Join rows to a table with one row per key, where a few keys may hold most rows.

    Hot keys are counted first. A hot key's rows are spread over as many parts as it holds shares, and only
    its row of the table is repeated, as often; all other keys are joined as they are. The result depends on
    values alone: the part of a row comes from what it holds, so rows equal in all of it stay together.
    """
    part, hot, parts = fresh([*rows.columns, *table.columns], "part", "hot", "parts")
    few = F.broadcast(stage(hot_keys(rows, key, share)).withColumnsRenamed({"hot": hot, "parts": parts}))
    spread = F.when(F.col(parts).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*_hashable(rows)), F.col(parts)).cast("int"))
    salted = rows.join(few, F.col(key) == F.col(hot), "left").withColumn(part, spread).drop(hot, parts)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))
    repeated = table.join(few, F.col(key) == F.col(hot), "left").withColumn(part, copies).drop(hot, parts)
    return salted.join(repeated, [key, part], how).drop(part)


MOST_BROADCAST = 200_000


def thin_side(staged: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """A staged table of a few narrow columns as the small side of a join with rows that carry content.

    Its rows are counted, from file footers: a small one is broadcast, so the other side stays where it
    is; a larger one is hashed in each partition, so the other side is dealt out but not sorted.
    """
    return F.broadcast(staged) if staged.count() <= most else staged.hint("shuffle_hash")


def _hashable(rows: DataFrame) -> list[str]:
    """Columns cheap to hash: text bodies and nested values are left out when others remain."""
    thin = [c for c, t in rows.dtypes if t in ("bigint", "int", "double", "timestamp", "timestamp_ntz", "date") or c == "url"]
    return thin or rows.columns
