"""Filters keep all columns of a document, whatever they are called, and lose no text."""

from edictum.llm import decontaminate, minhash, simhash, toxicity
from edictum.llm.common import prepare

NAMES = ["_utf8", "utf8", "keep", "_keep", "digest", "place", "part", "item_id"]
SCHEMA = "doc_id bigint, text string, " + ", ".join(f"{n} bigint" for n in NAMES)


def documents(spark):
    rng = __import__("random").Random(2)
    text = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(40))
    rows = [(i, text(), *range(i, i + len(NAMES))) for i in range(60)]
    rows += [(100 + i, rows[i][1].upper(), *range(len(NAMES))) for i in range(5)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_columns_named_like_helpers(spark):
    prepare(spark)
    rows, docs = documents(spark)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, rows[7][1])], "item_id int, text string")
    kept = toxicity.without_toxic(docs, toxicity.learn(docs, labels))
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= set(rows)
    assert sorted(map(tuple, decontaminate.without_leaks(docs, items).collect())) == sorted(r for r in rows if r[0] != 7)
    for module in (minhash, simhash):
        one = module.one_of_each(docs)
        assert one.columns == docs.columns and sorted(map(tuple, one.collect())) == sorted(rows[:60])


def test_item_ids_of_other_types(spark):
    prepare(spark)
    rows, docs = documents(spark)
    for kind, value in (("int", 5), ("string", "a"), ("smallint", 3)):
        items = spark.createDataFrame([(value, rows[9][1])], f"item_id {kind}, text string")
        assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()] == [(9, value)]


def test_an_id_with_two_texts_loses_none(spark):
    prepare(spark)
    schema = "doc_id bigint, text string, source string"
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, "s"), (1, b, "s"), (1, a, "t"), (1, a, "s"), (2, c, "s"), (3, c.upper(), "s"), (None, c, "s"), (None, c, "s")]
    for module in (minhash, simhash):
        found = [sorted(map(str, module.one_of_each(spark.createDataFrame(rows, schema).repartition(n)).collect())) for n in (1, 2, 5)]
        assert found[0] == found[1] == found[2]
        texts = sorted((r.doc_id or 0, r.text) for r in module.one_of_each(spark.createDataFrame(rows, schema)).collect())
        assert texts == sorted([(1, a), (1, b), (2, c), (0, c), (0, c)])
