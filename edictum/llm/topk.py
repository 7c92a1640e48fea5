"""Exact top-k by inner product: vectors in buckets of similar length, pruned per bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edictum.llm.common import stage, table

SCALE = 256
BUCKET = 4_096  # vectors of a bucket
SPREAD = 0.9  # the shortest vector of a bucket has at least this share of the longest one's length
QUERIES = 8_192  # queries looked up in one pass
FOCUS = 2  # coordinates a bucket is pruned by
STEEP = 0.4  # from this cosine on coordinates prune better than lengths

PACKED = "dim int, longest double, n int, ids binary, rows binary, lengths binary, data binary"
_PACKED = pa.schema([("dim", pa.int32()), ("longest", pa.float64()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("ids", "rows", "lengths", "data")]])


def scaled(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, is_query: Column | None = None) -> DataFrame:
    """(vec_id, v array of integers, asks, row, length) of the vectors that take part.

    Vectors that are NULL, without an id, empty, or hold a NULL or non-finite component take none.
    Components are taken as doubles. ``row`` tells rows apart, as long as the result is staged.
    """
    asks = F.lit(False) if is_query is None else F.coalesce(is_query, F.lit(False))
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"), asks.alias("asks"), F.monotonically_increasing_id().alias("row"))
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return rows.withColumn("length", F.sqrt(square))


def buckets(rows: DataFrame, size: int = BUCKET) -> DataFrame:
    """The vectors in rows of up to ``size`` of similar length, longest first, as packed matrices.

    Ranges of length are dealt out, equal lengths by id, so a vector that very many share is spread.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        own: list[int] = []
        lengths: list[float] = []
        data: list[bytes] = []
        dim = -1

        def close() -> pa.RecordBatch:
            return table(
                {"dim": [dim], "longest": [lengths[0]], "n": [len(ids)], "ids": [np.array(ids, "<i8").tobytes()],
                 "rows": [np.array(own, "<i8").tobytes()], "lengths": [np.array(lengths, "<f8").tobytes()], "data": [b"".join(data)]}, _PACKED,
            )

        for batch in batches:
            for vec_id, v, row, length in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                values = v.values.to_numpy(zero_copy_only=False)
                if ids and (len(values) != dim or len(ids) >= size or length < SPREAD * lengths[0]):
                    yield close()
                    ids, own, lengths, data = [], [], [], []
                dim = len(values)
                ids.append(vec_id)
                own.append(row)
                lengths.append(length)
                data.append(values.astype("<i8").tobytes())
        if ids:
            yield close()

    order = [F.size("v"), F.col("length").desc(), F.col("vec_id"), F.col("row")]
    return rows.select("vec_id", "v", "row", "length").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, PACKED)


class Bucket:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.rows = np.frombuffer(row["rows"], "<i8")
        self.lengths = np.frombuffer(row["lengths"], "<f8")
        self.data = np.frombuffer(row["data"], "<i8").reshape(row["n"], row["dim"])
        self.exact = self.data.astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.where(self.lengths[:, None] > 0, self.exact / self.lengths[:, None], 0.0)


class Search:
    """Top ``k`` of a block of queries, by their rows, over buckets that come one after the other."""

    def __init__(self, own: np.ndarray, data: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.own, self.data, self.k = own, data, k
        self.exact = data.astype(np.float64)
        self.lengths = np.sqrt((self.exact**2).sum(axis=1))
        # What a candidate must reach; the k-th best score so far, or a bound known beforehand.
        self.floor = np.full(len(own), -np.inf) if floor is None else floor.astype(np.float64)
        self.scores = [np.zeros(0, np.int64) for _ in own]
        self.found = [np.zeros(0, np.int64) for _ in own]

    def _take(self, j: int, bucket: Bucket, places: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= self.floor[j]) & (bucket.rows[places] != self.own[j])
        if not good.any():
            return
        all_scores = np.concatenate((self.scores[j], scores[good].astype(np.int64)))
        all_ids = np.concatenate((self.found[j], bucket.ids[places[good]]))
        best = np.lexsort((all_ids, -all_scores))[: self.k]
        self.scores[j], self.found[j] = all_scores[best], all_ids[best]
        if len(best) == self.k:
            self.floor[j] = max(self.floor[j], float(self.scores[j][-1]))

    def _products(self, rows: slice | np.ndarray, queries: np.ndarray, bucket: Bucket) -> np.ndarray:
        """Exact integer products; by floating point where every sum is an integer it can hold."""
        if self.lengths[queries].max(initial=0) * bucket.lengths[0] < 2**52:
            return bucket.exact[rows] @ self.exact[queries].T
        return bucket.data[rows] @ self.data[queries].T

    def visit(self, bucket: Bucket) -> None:
        longest = bucket.lengths[0]
        # No vector of the bucket can reach a floor above the product of the lengths.
        slack = 1e-9 * (1 + longest * self.lengths)
        open_ = np.flatnonzero(longest * self.lengths + slack >= self.floor)
        if not len(open_):
            return
        span = longest * self.lengths[open_]
        cosine = np.where(span > 0, self.floor[open_] / np.where(span > 0, span, 1), -1.0)
        by_length = open_[cosine < STEEP]
        for a in range(0, len(by_length), 256):
            part = by_length[a : a + 256]
            # Lengths fall: only a head of the bucket is long enough for the least demanding query.
            need = np.where(self.lengths[part] > 0, (self.floor[part] - slack[part]) / np.maximum(self.lengths[part], 1e-300), -np.inf)
            head = int(np.searchsorted(-bucket.lengths, -need.min(), side="right"))
            if not head:
                continue
            products = self._products(slice(0, head), part, bucket)
            some = np.flatnonzero((products >= self.floor[part]).any(axis=0))
            for c in some.tolist():
                places = np.flatnonzero(products[:, c] >= self.floor[part[c]])
                self._take(int(part[c]), bucket, places, products[places, c])
        for j, t in zip(open_[cosine >= STEEP].tolist(), cosine[cosine >= STEEP].tolist()):
            # A unit vector of cosine t or more has its coordinate f within an interval around t * q_f.
            q = self.exact[j] / self.lengths[j]
            t = min(1.0, t) - 1e-9
            near = np.ones(len(bucket.ids), bool)
            for f in np.argsort(-np.abs(q), kind="stable")[:FOCUS]:
                reach = np.sqrt(max(0.0, 1 - t * t) * max(0.0, 1 - q[f] * q[f])) + 1e-9
                if t > -q[f]:  # else the lower end is open, and below the upper one
                    near &= bucket.unit[:, f] >= q[f] * t - reach
                if t > q[f]:
                    near &= bucket.unit[:, f] <= q[f] * t + reach
            places = np.flatnonzero(near)
            if len(places):
                self._take(j, bucket, places, self._products(places, np.array([j]), bucket)[:, 0])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = [len(f) for f in self.found]
        if not sum(n):
            return (np.zeros(0, np.int64),) * 3
        return np.repeat(self.own, n), np.concatenate(self.found), np.concatenate(self.scores)


_FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _look_up(packed: DataFrame, own: np.ndarray, data: np.ndarray, k: int) -> DataFrame:
    """The best ``k`` of each task for one block of queries."""
    dim = data.shape[1]
    floor = np.full(len(own), -np.inf)
    # The longest bucket alone gives each query a floor to begin with.
    for row in packed.where(F.col("dim") == dim).orderBy(F.desc("longest"), F.desc("n")).limit(1).collect():
        first = Search(own, data, k)
        first.visit(Bucket(row.asDict()))
        floor = np.array([s[-1] if len(s) == k else -np.inf for s in first.scores], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(own, data, k, floor.copy())
        for batch in batches:
            for i in range(batch.num_rows):
                search.visit(Bucket(batch.slice(i, 1).to_pylist()[0]))
        queries, found, scores = search.rows()
        yield table({"query": queries, "vec_id": found, "score": scores}, _FOUND)

    return packed.where(F.col("dim") == dim).mapInArrow(run, "query bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products, ties to smaller vec_id.

    Queries go in blocks against all buckets; the driver holds one block. Each row that ``is_query`` asks
    for itself, so an id with two rows gets two lists. Candidates are all other rows with as many
    components, those that repeat its id or its vector too. No product is larger than that of the two
    longest lengths; where this passes 64 bits the table is refused.
    """
    spark = vectors.sparkSession
    rows = stage(scaled(vectors, is_query=is_query), "vectors")
    longest = rows.agg(F.max("length")).scalar()
    queries = rows.where("asks").select("row", "vec_id", "v", (longest * longest).alias("most")).orderBy(F.size("v"), "vec_id", "row")
    packed = stage(buckets(rows), "buckets")
    results: list[DataFrame] = []
    held: list = []

    def ask() -> None:
        own = np.array([r.row for r in held], np.int64)
        data = np.array([list(r.v) for r in held], np.int64)
        results.append(stage(_best(_look_up(packed, own, data, k), k), "nearest"))

    for row in queries.toLocalIterator():
        if row.most >= 2.0**63:
            raise ValueError(f"scores of vectors of length {row.most ** 0.5:.3g} (times {SCALE}) do not fit 64 bits")
        if held and (len(held) >= block or len(row.v) != len(held[0].v)):
            ask()
            held = []
        held.append(row)
    if held:
        ask()
    out = spark.createDataFrame([], "query bigint, rank int, vec_id bigint, score bigint")
    for r in results:
        out = out.unionByName(r)
    named = rows.where("asks").select("row", F.col("vec_id").alias("query_id"))
    return out.join(named, F.col("query") == F.col("row")).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per query of what the tasks found: ``k`` rows per task and query at most."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
