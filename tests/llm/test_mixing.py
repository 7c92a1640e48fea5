import random
from collections import Counter, defaultdict

import duckdb
import pytest

from edictum.llm import mixing
from edictum.llm.common import prepare
from edictum.llm.queries import ORACLES

SCHEMA = "doc_id bigint, text string, source string, size string, rows int"


def fixture(seed, sources):
    rng = random.Random(seed)
    out = [(i, " ".join(["w"] * int(rng.paretovariate(0.9))), rng.choice(sources), "x", 1) for i in range(600)]
    out += [(1000 + i, t, s, None, None) for i, (t, s) in enumerate([(None, "a"), ("", "b"), (" \t", None), ("x\x85y é\n", "z"), (None, "empty")])]
    return out


def water(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Share and reshare until no target is over its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed, sources", [(1, ["a", "b", None]), (2, ["a"] * 6 + list("bcdefgé")), (3, ["only"]), (4, ["Z", "z", "É", "日"])])
def test_targets_copies_and_sql(spark, seed, sources):
    prepare(spark)
    rows = fixture(seed, sources)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.size == len((dict((d, t) for d, t, *_ in rows)[r.doc_id] or "").encode().split())
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
    wanted = water(sizes)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(wanted[source[r.doc_id]])
    for s in sizes:
        longest = max(r.size for r in got if source[r.doc_id] == s)
        assert abs(taken[s] - wanted[s]) <= 2 * longest
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows])
    names = ["doc_id", "size", "source_size", "target", "taken", "copies"]
    theirs = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES['op10_mixing']})").fetchall()
    assert sorted(theirs) == sorted(tuple(r[n] for n in names) for r in got)


@pytest.mark.parametrize("seed", [5, 6])
def test_rows_without_id_are_taken_one_by_one(spark, seed):
    """Half of a source has no id and one size; the SQL ranks each row, and so does the operator."""
    prepare(spark)
    rows = fixture(seed, ["a", "b"]) + [(None, f"w {i}", "a", None, None) for i in range(2500)] + [(7, "same same", "b", None, None)] * 300
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mixing.mix_report(docs).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows])
    names = ["doc_id", "size", "source_size", "target", "taken", "copies"]
    theirs = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES['op10_mixing']})").fetchall()
    assert sorted(theirs, key=str) == sorted((tuple(r[n] for n in names) for r in got), key=str)
    out = Counter((r.doc_id, len((r.text or "").split())) for r in mixing.mixed(docs).collect())
    want = Counter()
    for r in got:
        want[r.doc_id, r.size] += r.copies
    assert out[None, 2] == want[None, 2] and out[7, 2] == want[7, 2]
    sizes, taken = Counter(), Counter()
    for d, t, s, *_ in rows:
        sizes[s] += len((t or "").split())
    for r in mixing.mixed(docs).collect():
        taken[r.source] += len((r.text or "").split())
    for s, target in water(sizes).items():
        assert abs(taken[s] - target) <= 2 * max(len((t or "").split()) for _, t, x, *_ in rows if x == s)


def test_columns_named_like_helpers_stay(spark):
    prepare(spark)
    names = ["m_size", "M_doc", "m_times", "m_place", "before", "ratio", "rows", "_copy", "_size", "r_doc", "part", "at"]
    rows = [(i % 5, "a b c", "s", *[100 * i + k for k in range(len(names))]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"{n} bigint" for n in names))
    out = mixing.mixed(docs).collect()
    assert len(out) == 18 and {tuple(r) for r in out} <= set(rows) and list(out[0].asDict()) == docs.columns


def test_documents_are_taken_as_often_as_reported(spark):
    prepare(spark)
    rows = fixture(5, ["a", "a", "b", None]) + [(None, "no id", "a", None, None), (3, "again", "a", None, None), (3, "again", "a", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    report = Counter()
    for r in mixing.mix_report(docs).collect():
        report[r.doc_id, r.size] += r.copies
    got = Counter((r.doc_id, len((r.text or "").encode().split())) for r in out.collect())
    assert got == +report
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mixed(docs.repartition(5)).collect()))
    assert mixing.mixed(docs.limit(0)).collect() == [] and mixing.mix_report(docs.limit(0)).collect() == []
