"""Near-duplicates by SimHash: fingerprints within a Hamming radius, found in BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.llm.common import stage, table, utf8
from edictum.llm.components import connected, keep_ids

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCKS = 6  # a fingerprint's 64 bits in so many blocks; at radius 4 two of them at least are equal
SHARD = 2_048  # fingerprints of a tree
FEW = 16  # up to so many fingerprints a tree is walked one by one


def shingle_hashes(text: bytes, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of words, repeats included; of all words where there are fewer."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z and ASCII white space alone
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    digest = xxhash.xxh64_intdigest
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *[e + 1 for e in ends]]
    n = len(words) - size + 1
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :])), np.uint64, n)


def fingerprint(text: bytes) -> int:
    """64 bits, each 1 if set in over half the shingles' hashes; 0 for a text without words."""
    return print_of(shingle_hashes(text))


def print_of(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        part = hashes[a : a + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little") if n else np.zeros(8, np.uint8)
    return int(bits.view("<u8")[0])


_PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of whole texts, fp as a signed 64-bit integer; one narrow pass. NULL counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield table({"doc_id": batch.column(0), "fp": prints}, _PRINTS)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


class BKTree:
    """A Burkhard-Keller tree: a node's children lie under their Hamming distance to it.

    Kept in arrays, so that all queries go down together: each step compares open (query, node)
    pairs and follows the edges from distance - radius to distance + radius.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        n = len(prints)
        self.first = np.zeros((n, 66), np.int64)  # children of a node up to each distance
        self.children = np.zeros(max(0, n - 1), np.int64)
        if not n:
            return
        # Place all fingerprints level by level: the members under one edge become a node and its subtree.
        groups = [(0, np.arange(1, n))]
        filled = 0
        while groups:
            following = []
            for node, members in groups:
                if not len(members):
                    self.first[node] = filled
                    continue
                distance = np.bitwise_count(prints[members] ^ prints[node]).astype(np.int64)
                order = np.argsort(distance, kind="stable")
                members, distance = members[order], distance[order]
                heads = np.flatnonzero(np.r_[True, distance[1:] != distance[:-1]])
                edge = distance[heads]
                self.first[node] = filled + np.searchsorted(edge, np.arange(66))
                self.children[filled : filled + len(heads)] = members[heads]
                filled += len(heads)
                for head, end in zip(heads.tolist(), [*heads[1:].tolist(), len(members)]):
                    following.append((int(members[head]), members[head + 1 : end]))
            groups = following

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) places of all pairs within the radius, a level of the tree at a time."""
        if not len(self.prints) or not len(queries):
            return
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(q):
            distance = np.bitwise_count(queries[q] ^ self.prints[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield q[near], node[near]
            low = self.first[node, np.maximum(distance - radius, 0)]
            high = self.first[node, np.minimum(distance + radius + 1, 65)]
            n = high - low
            place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            q, node = np.repeat(q, n), self.children[place]


def _few_links(prints: list[int], radius: int) -> list[tuple[int, int]]:
    """Links of a small shard: each fingerprint is looked up in the tree of those before it, then put in."""
    links = []
    root: tuple[int, dict] | None = None
    for fp in prints:
        if root is None:
            root = (fp, {})
            continue
        open_ = [root]
        while open_:
            other, edges = open_.pop()
            distance = (fp ^ other).bit_count()
            if distance <= radius:
                links.append((fp, other))
            open_ += [child for d, child in edges.items() if distance - radius <= d <= distance + radius]
        at = root
        while (child := at[1].get((fp ^ at[0]).bit_count())) is not None:
            at = child
        at[1][(fp ^ at[0]).bit_count()] = (fp, {})
    return links


def spanning_links(prints: np.ndarray, others: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that join what lies within the radius, no more than a forest of them.

    Within one shard, or between a shard's tree and another shard's fingerprints. Queries go in
    slices, so that the pairs held at a time are bounded; of the pairs found only those that join
    two parts are kept.
    """
    queries = prints if others is None else others
    if others is None and len(prints) <= FEW:
        return _few_links(prints.tolist(), radius)
    tree = BKTree(prints)
    shift = 0 if others is None else len(prints)
    parent = list(range(len(prints) + (len(others) if others is not None else 0)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for a in range(0, len(queries), 512):
        for q, node in tree.within(queries[a : a + 512], radius):
            if others is None:
                fresh = q + a > node
                q, node = q[fresh], node[fresh]
            for x, y in zip((q + a).tolist(), node.tolist()):
                i, j = find(x + shift), find(y)
                if i != j:
                    parent[i] = j
                    links.append((int(queries[x]), int(prints[y])))
    return links


def block_keys(blocks: int = BLOCKS, radius: int = RADIUS) -> list[tuple[int, int]]:
    """(mask, number) of every choice of blocks that two fingerprints within the radius may share whole."""
    from itertools import combinations

    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [(sum(masks[i] for i in c), k) for k, c in enumerate(combinations(range(blocks), blocks - radius))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect every two different fingerprints within ``radius`` bits.

    ``prints`` has each fingerprint once. Two that differ in ``radius`` bits share ``blocks - radius``
    of ``blocks`` blocks whole, so every choice of blocks gives a key, and only fingerprints with an
    equal key can be near. A key's members are dealt into shards of about ``shard``, by hash; each
    shard is a BK-tree, queried with the members of itself and of the later shards. A key shared by
    very many is so many bounded tasks, none of them with all members.
    """
    if blocks <= radius:
        raise ValueError("more blocks than bits that may differ are needed")
    keys = F.array(*[F.struct(F.lit(k).alias("no"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for m, k in block_keys(blocks, radius)])
    keyed = prints.select("fp", F.explode(keys).alias("key")).select("fp", "key.no", "key.bits")
    shared = keyed.groupBy("no", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = shared.select("no", "bits", F.ceil(F.col("n") / F.lit(shard)).cast("int").alias("shards"))
    members = keyed.join(shared, ["no", "bits"])
    own = F.pmod(F.xxhash64("fp", F.lit(11)), F.col("shards")).cast("int")
    members = members.withColumn("own", own)
    # A member goes to the pairs of shards that its own takes part in: (its own, any later) and (any earlier, its own).
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda s: F.struct(F.least(s, F.col("own")).alias("tree"), F.greatest(s, F.col("own")).alias("asked")),
    )
    dealt = members.select("fp", "no", "bits", "own", F.explode(pairs).alias("pair")).select("fp", "no", "bits", "own", "pair.tree", "pair.asked")
    group = ["no", "bits", "tree", "asked"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rest: dict[str, np.ndarray]) -> list[tuple[int, int]]:
            fp, own, tree = rest["fp"].view(np.uint64), rest["own"], rest["tree"][0]
            if tree == rest["asked"][0]:
                return spanning_links(fp, None, radius)
            return spanning_links(fp[own == tree], fp[own != tree], radius)

        links: list[tuple[int, int]] = []
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            columns = {n: batch.column(n).to_numpy() for n in ("fp", "own", *group)}
            if held is not None:
                columns = {n: np.concatenate((held[n], columns[n])) for n in columns}
            change = np.zeros(len(columns["fp"]), bool)
            change[:1] = True
            for n in group:
                change[1:] |= columns[n][1:] != columns[n][:-1]
            starts = np.flatnonzero(change)
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                links += found({n: c[a:b] for n, c in columns.items()})
            held = {n: c[starts[-1] :] for n, c in columns.items()} if len(starts) else None
            if len(links) > 10_000:
                yield _table_of(links)
                links = []
        if held is not None:
            links += found(held)
        if links:
            yield _table_of(links)

    sorted_ = dealt.repartition(*group).sortWithinPartitions(*group, "fp")
    return sorted_.mapInArrow(run, "a bigint, b bigint")


def _table_of(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, np.uint64).view(np.int64)
    return table({"a": pairs[:, 0], "b": pairs[:, 1]}, _LINKS)


def components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every document; component_id is the smallest doc_id reachable.

    Only different fingerprints are compared, so copies cost nothing. Documents without text or words
    have fingerprint zero and are linked like any other; those without an id take part, and their
    component_id is NULL where no document of the component has one.
    """
    printed = stage(fingerprints(docs), "prints")
    distinct = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    links = near_links(distinct.select("fp"), radius)
    rooted = connected(links)
    placed = distinct.join(rooted, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(placed.join(smallest, "root").select(F.col("fp").alias("c_fp"), "component_id"), "classes")
    return printed.join(classes, F.col("fp") == F.col("c_fp")).select("doc_id", "fp", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint in hexadecimal, component_id)."""
    return components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component, columns as they were.

    Rows that repeat that id and its text are one document and leave one row; other texts under that id
    stay. A document without an id cannot be told from others and stays.
    """
    printed = components(docs.where("doc_id IS NOT NULL"))
    return keep_ids(docs, printed.where("doc_id = component_id").select("doc_id"))
