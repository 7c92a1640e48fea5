"""The gram index and the bloom filters of a stored policy table."""

import datetime as dt
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from edictum.operators import grams, search
from edictum.session import shared_dir
from edictum.sources import tables

SCHEMA = "id bigint, title string, doc_number string, issuing_authority string, publish_date date, validity_status string, source_url string, content string, tags string"


def rows(n, first=0, seed=1):
    rng = random.Random(seed + first)
    word = lambda: "".join(rng.choices("abcdeé药品集采X", k=rng.randint(1, 7)))
    return [(i, word(), rng.choice([None, f"号〔{i}〕"]), "A", dt.date(2024, 1 + i % 12, 3), "有效", f"https://a/{i}", " ".join(word() for _ in range(rng.randint(0, 40))), "[]")
            for i in range(first, first + n)]


@pytest.fixture(scope="module")
def root(spark):
    return f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"


def read(spark, root):
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{root}/rows")


def test_search_by_grams_is_search(spark, root):
    everything = []
    for part in range(3):
        some = rows(60, 100 * part)
        everything += some
        spark.createDataFrame(some, SCHEMA).repartition(6).write.parquet(f"{root}/rows/{part}")
        table = read(spark, root)
        if part < 2:  # the last files are not in the index
            assert grams.update_index(table, f"{root}/index") == 6 and grams.update_index(table, f"{root}/index") == 0
    plain = spark.createDataFrame(everything, SCHEMA)
    rng = random.Random(4)
    words = ["集采", "药品集", "ABC", "éa药", "号〔10", "a%b", "abc%", "%", "_", "ab_de", "nothing here", "", "x", "药品%集采X", "\\", "集采X药"]
    words += ["".join(rng.choice([r[7], r[1]])[k : k + 4]) for r in rng.sample(everything, 12) for k in (0, 5)]
    for w in words:
        want = sorted(r.id for r in search.search(plain, keyword=w, status="有效").collect())
        assert sorted(r.id for r in grams.search_stored(table, f"{root}/index", w, status="有效").collect()) == want, w
    assert sum(len(search.search(plain, keyword=w).limit(1).collect()) for w in words) > 10


def test_only_candidate_files_are_read(spark, root):
    at = f"{root}/one"
    some = [(*r[:7], r[7] + (" uniqueword" if r[0] == 33 else ""), r[8]) for r in rows(64)]
    spark.createDataFrame(some, SCHEMA).repartition(8).write.parquet(f"{at}/rows")
    table = spark.read.schema(SCHEMA).parquet(f"{at}/rows")
    grams.update_index(table, f"{at}/index")
    found = grams.search_stored(table, f"{at}/index", "QUEWOR")
    assert [r.id for r in found.collect()] == [33] and len(found.inputFiles()) == 1 and len(table.inputFiles()) == 8


def scanned(df):
    """Rows the scan of a query gave out: those of the row groups that were read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_point_lookups_read_few_row_groups(spark, root):
    # Random ids and URLs, so that the smallest and largest of a row group tell nothing.
    some = spark.range(40_000).select(
        F.xxhash64("id").alias("id"), F.lit("t").alias("title"), F.lit("").alias("doc_number"), F.lit("A").alias("issuing_authority"),
        F.expr("DATE '2024-01-01' + CAST(id % 300 AS INT)").alias("publish_date"), F.lit("有效").alias("validity_status"),
        F.concat(F.lit("https://a/"), F.md5(F.col("id").cast("string"))).alias("source_url"), F.repeat(F.md5(F.col("id").cast("string")), 20).alias("content"), F.lit("[]").alias("tags"),
    )
    tables.write_policies(some, f"{root}/bloom", group_bytes=1 << 20)
    table = spark.read.parquet(f"{root}/bloom")
    row = some.where("id % 1000 = 7").first()
    for found in (search.by_url(table, row.source_url), search.by_id(table, row.id)):
        assert [r.id for r in found.collect()] == [row.id]
        assert scanned(found) < 0.2 * 40_000
    assert search.by_url(table, "https://a/none").collect() == [] and scanned(search.by_url(table, "https://a/none")) < 0.2 * 40_000


def test_grams_of_short_and_wide_text(values):
    assert values(grams.grams(F.col("v")), ["", "ab", "ABc", "药品集采", "a🙂bc", None]) == [[], [], ["abc"], ["药品集", "品集采"], ["a🙂b", "🙂bc"], None]
    assert grams.pieces("a%%b_c") == ["a", "b", "c"] and re.match("file:///", grams._plain("file:/x"))


ODD = ["", "ab", "ABc", "药品集采", "a🙂bc", None, "İstanbul ΑΣ ẞ", "nul\x00 in\n\tit", "x" * 50, "\ufffd\uffff", "the word the word " * 40, "集采药品追溯码" * 30]


def test_gram_rows_are_grams(spark):
    some = [("f1" if k < 7 else "f2", ODD[k], ODD[-k - 1], ODD[(5 * k) % len(ODD)]) for k in range(len(ODD))]
    texts = spark.createDataFrame(some, "file string, title string, content string, doc_number string").repartition(2)
    texts = texts.unionByName(spark.sql("SELECT 'f3' AS file, CAST(X'41FF42E8AF434445' AS STRING) AS title, CAST(X'41FF' AS STRING) AS content, CAST(NULL AS STRING) AS doc_number"))
    each = F.explode(F.concat(*[F.coalesce(grams.grams(F.col(c)), F.array().cast("array<string>")) for c in grams.SEARCHED]))
    want = {tuple(r) for r in texts.select("file", each).collect()}
    assert len(want) > 70 and len({f for f, _ in want}) == 3
    for block in (1, 2, 7, 64, grams.BLOCK):
        assert {tuple(r) for r in grams.gram_rows(texts, block).collect()} == want, block


def test_repeated_grams_stay_in_the_task(spark):
    texts = spark.range(0, 2000, 1, 2).selectExpr("'f' AS file", "'The same title' AS title", "repeat('The same text ', 9) AS content", "'' AS doc_number")
    assert grams.gram_rows(texts).count() <= 2 * 30


def test_known_files_are_not_read_again(spark, root, monkeypatch):
    at, seen, made = f"{root}/again", [], grams.gram_rows
    monkeypatch.setattr(grams, "gram_rows", lambda texts: seen.append(texts) or made(texts))
    for part, n in enumerate((90, 20)):
        spark.createDataFrame(rows(n, 100 * part), SCHEMA).repartition(3).write.parquet(f"{at}/rows/{part} é")
        table = read(spark, at)
        assert grams.update_index(table, f"{at}/index") == 3
    assert [scanned(texts) for texts in seen] == [90, 20]
    assert grams.read_files(spark, f"{at}/index").distinct().count() == 6


def test_texts_without_the_caseless_part_are_not_folded(spark, root):
    assert [grams.caseless_part(k) for k in ("废止%the", "SRC1〔2021〕", "abc", "a12b345", "k\u0307é", "12%药品集")] == ["废止", "1〔2021〕", "", "345", "", "药品集"]
    at = f"{root}/part"
    texts = ["SRC1〔2021〕7号", "src1〔2021〕", "src1〔2020〕", None, "废止 THE", "the 废止"]
    some = [(k, a, b, "A", dt.date(2024, 1, 1), "有效", f"https://a/{k}", c, "[]") for k, (a, b, c) in enumerate((a, b, c) for a in texts for b in texts for c in texts)]
    spark.createDataFrame(some, SCHEMA).repartition(3).write.parquet(f"{at}/rows")
    table = read(spark, at)
    grams.update_index(table, f"{at}/index")
    for w in ("Src1〔2021〕", "废止%the", "2020", "废止"):
        want = sorted(r.id for r in search.search(table, keyword=w).collect())
        found = grams.search_stored(table, f"{at}/index", w)
        assert want and sorted(r.id for r in found.collect()) == want, w
        assert "contains(" in found._jdf.queryExecution().optimizedPlan().toString().lower()
