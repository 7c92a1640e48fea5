import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from edictum.llm import topk
from edictum.llm.common import prepare
from edictum.llm.queries import ORACLES

SCHEMA = "vec_id bigint, embedding array<float>, label int, length string, v string"


def brute(rows, k, is_query):
    ok = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, q) in enumerate(ok):
        if is_query(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(ok) if m != n and len(v) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def rows(kind):
    rng = np.random.default_rng(3)
    if kind == "close":  # high cosines, so that coordinates prune
        centres = rng.normal(size=(6, 8))
        data = [centres[i % 6] * rng.uniform(0.5, 3) + rng.normal(scale=0.02, size=8) for i in range(400)]
    elif kind == "lengths":
        data = [rng.normal(size=8) * 10 ** rng.uniform(-2, 2) for _ in range(400)]
    else:
        data = [rng.integers(-1, 2, 8).astype(float) for _ in range(400)]
    out = [(i, [float(x) for x in v], 0, "x", "y") for i, v in enumerate(data)]
    out += [(1000, None, 1, None, None), (1020, [], 1, None, None), (1040, [1.0, None] * 4, 1, None, None), (1060, [float("nan")] * 8, 1, None, None)]
    out += [(1080, [float("inf")] * 8, 1, None, None), (None, [1.0] * 8, 1, None, None), (1100, [0.0] * 8, 1, None, None), (2000, [1.0, 2.0], 1, None, None), (2001, [3.0, 2.0], 1, None, None)]
    return [*out, out[40], out[41], out[41]]


@pytest.mark.parametrize("kind", ["close", "lengths", "ties"])
def test_against_all_products(spark, kind, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(topk, "BUCKET", 32)
    frame = spark.createDataFrame(rows(kind), SCHEMA)
    for block in (7, topk.QUERIES):
        got = topk.top_k(frame, F.col("vec_id") % 20 == 0, 5, block)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows(kind), 5, lambda i: i % 20 == 0)


def test_coordinates_and_lengths_prune(spark):
    """Pruned search meets fewer candidates than there are, and the same results."""
    data = np.array([[math.floor(256 * x) for x in r[1]] for r in rows("close")[:400]])
    lengths = np.sqrt((data.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-lengths)
    seen = []

    class Counting(topk.Search):
        def _products(self, places, queries, bucket):
            out = super()._products(places, queries, bucket)
            seen.append(out.size)
            return out

    search = Counting(np.arange(20), data[:20], 5)
    for a in range(0, 400, 25):
        part = order[a : a + 25]
        search.visit(topk.Bucket({"ids": part.astype("<i8").tobytes(), "rows": part.astype("<i8").tobytes(), "lengths": lengths[part].tobytes(), "data": data[part].astype("<i8").tobytes(), "n": len(part), "dim": 8}))
    assert sum(seen) < 0.5 * 20 * 400
    for j in range(20):
        products = data @ data[j]
        best = sorted((-int(products[i]), i) for i in range(400) if i != j)[:5]
        assert [(-int(s), int(i)) for s, i in zip(search.scores[j], search.found[j])] == best


def test_an_id_with_two_vectors_and_the_sql(spark):
    prepare(spark)
    vectors = [(0, [1.0, 0.5]), (0, [-1.0, 0.25]), (1, [2.0, 1.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0]), (7, [-3.0, 0.0]), (8, [0.0, 0.0])]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()))
    assert got == brute(vectors, 5, lambda i: i % 50 == 0) and len(got) == 20
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", vectors)
    assert sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLES['op8_top_k']})").fetchall()) == got


def test_scores_beyond_64_bits_are_refused(spark):
    prepare(spark)
    for big in (1e30, 2.0**24):
        with pytest.raises(ValueError, match="64 bits"):
            topk.top_k(spark.createDataFrame([(0, [big, 0.0]), (1, [1.0, 1.0])], "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0)
    near = spark.createDataFrame([(0, [2.0**23, 0.0]), (1, [2.0**23, 1.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(near, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2**62)]


def test_no_vectors(spark):
    prepare(spark)
    frame = spark.createDataFrame(rows("ties"), SCHEMA)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert topk.top_k(frame, F.lit(False)).collect() == []
    assert topk.top_k(frame.where("vec_id = 20"), F.col("vec_id") % 20 == 0).collect() == []
