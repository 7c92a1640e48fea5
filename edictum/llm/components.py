"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edictum.functions.names import fresh
from edictum.llm.common import stage, unstage

ROUNDS = 60


def connected(links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the smallest node it can reach.

    Large-star and small-star steps in turn: each node points its larger neighbours, then its
    smaller ones, at the smallest it knows, until a round changes nothing; the number of rounds
    grows with the logarithm of the longest chain. Each step aggregates before it joins, so a node
    with very many links is one row per task, and every round is staged in the shared folder.
    """
    edges = stage(_tidy(links), "links")
    for _ in range(rounds):
        grown = _star(edges, larger=True)
        small = stage(_tidy(_star(grown, larger=False)), "links")
        same = small.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first() == edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        unstage(edges)
        edges = small
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _tidy(links: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links of a node's larger (or smaller) neighbours, and in the latter case itself, to its smallest one."""
    if larger:
        around = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("k", "m").alias("m"))
    joined = around.join(least, F.col("a") == F.col("k"))
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b")))


def keep_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with one of the ids, and all without an id; columns as they were, whatever their names.

    Of rows that repeat an id and its text one stays, the same in every run; another text under an id is
    another document. Only ids that repeat are looked at twice, and only their rows are sorted.
    """
    key, digest, place = fresh(docs, "keep", "digest", "place")
    same = F.col("doc_id") == F.col(key)
    keep = ids.select(F.col("doc_id").alias(key)).distinct()
    named = docs.where("doc_id IS NOT NULL").join(keep, same, "left_semi")
    counts = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.count(F.lit(1)).alias(digest))
    repeated = stage(counts.where(F.col(digest) > 1).select(key), "repeated")
    if not repeated.isEmpty():
        order = Window.partitionBy("doc_id", digest).orderBy(F.xxhash64(F.to_json(F.struct(*docs.columns))))
        again = named.join(repeated, same, "left_semi").withColumn(digest, F.md5(F.col("text").cast("string").cast("binary")))
        one = again.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*docs.columns)
        named = named.join(repeated, same, "left_anti").unionByName(one)
    return named.unionByName(docs.where("doc_id IS NULL"))
