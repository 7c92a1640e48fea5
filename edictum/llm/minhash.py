"""Near copies by SimHash fingerprints in BK-trees, then an exact check of the Jaccard similarity.

Pairs beyond the radius of the fingerprints come by MinHash bands and go through the same check.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.llm.common import stage, table, utf8
from edictum.llm.components import connected, keep_ids
from edictum.llm.simhash import RADIUS, near_links, print_of, shingle_hashes

SHINGLE = 5
LEAST = 0.8  # shared shingles over all shingles of a pair of near copies
ROWS, BANDS = 5, 32  # a pair at 0.8 shares no band once in 300,000 pairs
SHARD = 1_000_000  # shingles of a shard of candidates


def _multipliers() -> np.ndarray:
    return np.random.default_rng(42).integers(1, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)


MULTIPLIERS = _multipliers()


def shingle_set(text: bytes) -> np.ndarray:
    """The different shingle hashes of a text, in order; a text of fewer words is one shingle."""
    return np.unique(shingle_hashes(text, SHINGLE))


def set_digest(hashes: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SHINGLE)).view(np.int64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key per band of MinHash values; none for a text without words."""
    import xxhash

    if not len(hashes):
        return []
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 512):
        np.minimum(least, np.multiply.outer(MULTIPLIERS, hashes[a : a + 512]).min(axis=1), out=least)
    bands = [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(bands, np.uint64).view(np.int64).tolist()


_SIGNED = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64()))])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n, fp, bands) of whole texts; ``node`` is a digest of the shingle set, ``n`` its size, ``fp`` its SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py()) for t in batch.column(1)]
            prints = np.array([print_of(s) for s in sets], np.uint64).view(np.int64)
            columns = {"doc_id": batch.column(0), "node": [set_digest(s) for s in sets], "n": [len(s) for s in sets]}
            yield table(columns | {"fp": prints, "bands": [band_keys(s) for s in sets]}, _SIGNED)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, node bigint, n bigint, fp bigint, bands array<bigint>")


def similar_links(nodes: list[int], sets: list[np.ndarray], own: list[int], across: bool, least: float = LEAST) -> list[tuple[int, int]]:
    """Links that join all sets at least ``least`` similar, no more than a forest of them; with ``across`` of unequal ``own`` alone.

    Of two such sets of any order, the first n - ceil(least n) + 1 elements share one. Rare elements come
    first here, so few others are met; what is joined already is not compared again.
    """
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(values))
    often = np.sort(count) > 1
    ends = np.cumsum([len(s) for s in sets])
    ranked = [np.sort(rank[place[e - len(s) : e]]) for s, e in zip(sets, ends.tolist())]
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    met: dict[int, list[int]] = defaultdict(list)
    for x, mine in enumerate(ranked):
        n = len(mine)
        head = mine[: n - ceil(least * n - 1e-9) + 1]
        head = head[often[head]].tolist()
        for y in {y for r in head for y in met.get(r, ())}:
            other = ranked[y]
            if (across and own[x] == own[y]) or min(n, len(other)) < least * max(n, len(other)) - 1e-9 or (i := find(x)) == (j := find(y)):
                continue
            both = len(np.intersect1d(mine, other, assume_unique=True))
            if both / (n + len(other) - both) >= least:
                parent[i] = j
                links.append((nodes[x], nodes[y]))
        for r in head:
            met[r].append(x)
    return links


def candidates(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, root) of the sets whose fingerprints lie within the radius or that share a band key, directly or through others.

    Fingerprints are compared in BK-trees, each different one once; those that hang together are one
    key, beside the keys of the bands. Texts without words are equal already and are not looked up.
    """
    prints = distinct.where("n > 0").select("fp").distinct()
    near = connected(near_links(prints, radius)).select(F.col("node").alias("f_node"), F.col("root").alias("f_root"))
    placed = distinct.where("n > 0").join(near, F.col("fp") == F.col("f_node"), "left")
    print_key = F.xxhash64(F.coalesce("f_root", "fp"), F.lit(BANDS))
    keyed = placed.select("node", F.explode(F.concat(F.array(print_key), "bands")).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last").select(F.col("key").alias("s_key"), "b")
    return connected(keyed.join(shared, F.col("key") == F.col("s_key")).select(F.col("node").alias("a"), "b"))


def checked_links(docs: DataFrame, distinct: DataFrame, rooted: DataFrame, least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that join every two candidates of a group whose shingle sets are similar, by their texts.

    A group's members are dealt into shards of about ``shard`` shingles; every shard meets itself and
    every other, so a large group is so many bounded tasks.
    """
    members = distinct.join(rooted.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"))
    members = stage(members.select("node", "doc_id", "n", "root"), "members")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(shard)).cast("int").alias("shards")).withColumnRenamed("root", "s_root")
    members = members.join(sizes, F.col("root") == F.col("s_root")).withColumn("own", F.pmod(F.xxhash64("node", F.lit(11)), F.col("shards")).cast("int"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("t_id"), utf8().alias("text"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda s: F.struct(F.least(s, F.col("own")).alias("tree"), F.greatest(s, F.col("own")).alias("asked")),
    )
    dealt = texts.join(members, F.col("t_id") == F.col("doc_id")).select("node", "root", "own", "text", F.explode(pairs).alias("pair"))
    dealt = dealt.select("node", "root", "own", "text", "pair.tree", "pair.asked")
    group = ["root", "tree", "asked"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: dict[int, tuple[np.ndarray, int]] = {}

        def found() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                links = similar_links(list(held), [s for s, _ in held.values()], [o for _, o in held.values()], at[1] != at[2], least)
                if links:
                    yield table({"a": [a for a, _ in links], "b": [b for _, b in links]}, _LINKS)

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("node", "own", *group)]
            texts = batch.column("text")
            for k, (node, own, *key) in enumerate(zip(*columns)):
                if tuple(key) != at:
                    yield from found()
                    at, held = tuple(key), {}
                if node not in held:
                    hashes = shingle_set(texts[k].as_py())
                    if set_digest(hashes) == node:  # rows may repeat an id with another text
                        held[node] = hashes, own
        yield from found()

    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "a bigint, b bigint")


def components(docs: DataFrame, least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """(doc_id, component_id) of every document; component_id is the smallest doc_id reachable over near copies.

    Two texts are near copies if their sets of five-word shingles have a Jaccard similarity of at
    least ``least``, or are equal; texts without words are equal. A pair is compared exactly if its
    SimHash fingerprints lie within the radius, if it shares one of 32 bands, or is joined by others that do.
    """
    signed = stage(signatures(docs), "signatures")
    distinct = stage(signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "distinct")
    rooted = connected(checked_links(docs, distinct, candidates(distinct), least, shard))
    placed = distinct.select("node", "doc_id").join(rooted.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left")
    placed = placed.select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = stage(placed.join(smallest, "root").select(F.col("node").alias("c_node"), "component_id"), "classes")
    return signed.join(classes, F.col("node") == F.col("c_node")).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The document with the smallest id of each component, columns as they were.

    Rows that repeat that id and its text are one document and leave one row; other texts under that id
    stay. A document without an id cannot be told from others and stays.
    """
    named = components(docs.where("doc_id IS NOT NULL"), least)
    return keep_ids(docs, named.where("doc_id = component_id").select("doc_id"))
