"""Whole jobs and streams, and every registered query against its SQL."""

import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from edictum.operators import upsert
from edictum.operators.registry import source_table
from edictum.plans import ingest, offline_build
from edictum.schemas import FEED, POLICIES, REQUEST_LOG
from edictum.session import stage
from edictum.streaming import ingest as streaming
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
PAGES = "page_id bigint, source string, url string, base string, html string, run_id string"


def test_crawl_job_twice(spark):
    base = "https://www.nhc.gov.cn"
    item = lambda n, day: f'<li><a href="/fzs/c/202607/p{n}.shtml">关于第{n}号的通告</a>{day}</li>'
    lists = [(1, "nhc", f"{base}/fzs/l.shtml", "", item(1, "2026-07-29") + item(2, "2026-07-28") + item(3, "2026-01-01") + item(4, "2026-07-27"), "r1"),
             (2, "nhc", f"{base}/fzs/l.shtml", "", item(9, "2026-07-29"), "blocked")]
    page = lambda n: f'<meta name="ArticleTitle" content="第{n}号"><div id="xw_box">联系13812345678 {"文" * 30}<a href="f{n}.pdf">a</a></div>时间：2026-07-2{n}'
    docs = [(10 + n, "nhc", f"{base}/fzs/c/202607/p{n}.shtml", "", page(n), "r1") for n in (1, 2, 3, 4)]
    docs += [(19, "nhc", f"{base}/fzs/c/202607/p9.shtml", "", page(9), "blocked")]
    robots = spark.createDataFrame([("www.nhc.gov.cn", "User-agent: *\nDisallow: /fzs/c/202607/p4")], "host string, body string")
    log = spark.createDataFrame([("blocked", 1, "u", 1, 403, 0.1, None), ("r1", 2, "u", 1, 200, 0.1, None)], REQUEST_LOG)
    texts = spark.createDataFrame([(f"{base}/fzs/c/202607/f1.pdf", "doc", "附件文字")], "url string, kind string, text string")
    batch = ingest.crawl_batch(
        spark.createDataFrame(lists, PAGES), spark.createDataFrame(docs, PAGES), source_table(spark), "2026-08-01",
        days=7, limit=50, robots=robots, requests=log, attachment_text=texts,
    )
    rows = {r.title: r for r in batch.collect()}
    assert sorted(rows) == ["第1号", "第2号"]
    assert rows["第1号"].content.endswith("[附件] 附件文字") and "138" not in rows["第1号"].content + rows["第1号"].raw_html
    assert rows["第2号"].issuing_authority == "国家卫生健康委" and rows["第2号"].publish_date == "2026-07-22"

    stored = spark.createDataFrame([], POLICIES)
    first = ingest.ingest(batch, stored, spark.createDataFrame([], FEED + ", pos bigint"), "nhc", F.lit("2026-08-01 08:00:00"))
    assert first.policies.columns == stored.columns
    after = spark.createDataFrame(first.policies.collect(), stored.schema)
    assert sorted(r.id for r in after.collect()) == [1, 2]
    assert first.log.collect()[0].new_added == 2 and first.feed.count() == 2
    again = ingest.ingest(batch, after, spark.createDataFrame([], FEED + ", pos bigint"), "nhc", F.lit("2026-08-02 08:00:00"))
    assert again.log.collect()[0].new_added == 0 and again.policies.count() == 2
    assert ingest.raw_pages(batch).count() == 2


def test_runs_are_kept_apart(spark):
    base = "https://www.nhc.gov.cn/fzs/c/202607"
    item = lambda n: f'<li><a href="/fzs/c/202607/p{n}.shtml">关于第{n}项的说明</a>2026-07-29</li>'
    page = lambda words: f'<meta name="ArticleTitle" content="{words}"><div id="xw_box">{"文" * 30}</div>'
    lists = [(1, "nhc", f"{base}/l.shtml", "", item(1) + item(2) + item(3), "r1"), (2, "nhc", f"{base}/l.shtml", "", item(1) + item(2), "r2"),
             (3, "nhc", f"{base}/l.shtml", "", item(1), None)]
    docs = [(11, "nhc", f"{base}/p1.shtml", "", page("甲"), "r1"), (12, "nhc", f"{base}/p1.shtml", "", page("乙"), "r1"),
            (13, "nhc", f"{base}/p1.shtml", "", page("丙"), "r2"), (14, "nhc", f"{base}/p3.shtml", "", page("丁"), "r1"),
            (15, "nhc", f"{base}/p2.shtml", "", page("戊"), "r3"), (16, "nhc", f"{base}/p1.shtml", "", page("己"), None)]
    lists, docs = spark.createDataFrame(lists, PAGES), spark.createDataFrame(docs, PAGES)
    sources = source_table(spark)
    titles = lambda **o: sorted((r.run_id, r.title) for r in ingest.crawl_batch(lists, docs, sources, "2026-08-01", **o).collect())
    assert titles(limit=None) == [("", "己"), ("r1", "丁"), ("r1", "乙"), ("r2", "丙")]
    assert titles(limit=2) == [("", "己"), ("r1", "乙"), ("r2", "丙")]
    one = ingest.crawl_batch(lists.drop("run_id"), docs.drop("run_id"), sources, "2026-08-01", limit=None)
    assert sorted(r.title for r in one.collect()) == ["丁", "己", "己", "己", "戊", "戊"]
    with pytest.raises(ValueError):
        ingest.crawl_batch(lists.drop("run_id"), docs, sources, "2026-08-01", requests=spark.createDataFrame([], REQUEST_LOG))


def test_staged_columns_are_read_alone(spark):
    staged = stage(spark.createDataFrame([(1, "x", "long")], "id int, title string, content string"))
    plan = staged.select("title")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan[plan.index("ReadSchema") :] and staged.count() == 1


def test_offline_build(spark):
    lists = [(1, "nhsa", "l", "", '<li><a href="/art/2026/7/17/art_1_2.html">关于某事的通知</a>2026-07-17</li><li><a href="/art/2026/7/16/art_1_3.html">另外的通知</a></li>', "")]
    docs = [(2, "nhsa", "https://www.nhsa.gov.cn/art/2026/7/17/art_1_2.html", "", "<h1>国家局关于某事的通知</h1><div class='text'>" + "文" * 30 + "</div>", "")]
    sources = source_table(spark)
    items, documents = offline_build.list_documents(spark.createDataFrame(lists, PAGES), spark.createDataFrame(docs, PAGES), sources)
    rows = offline_build.build_policies(items, documents, sources).orderBy("pos").collect()
    assert [(r.content, r.issuing_authority) for r in rows] == [("文" * 30, "国家医疗保障局"), ("", "国家医疗保障局")]
    reports = {r.source: r for r in offline_build.build_summary(items, documents, sources).collect()}
    assert sorted(reports) == sorted(r.id for r in sources.collect())
    assert (reports["nmpa"].list_items, reports["nmpa"].detail_title, reports["nmpa"].matched_item) == (0, "", None)
    report = reports["nhsa"]
    assert (report.list_items, report.detail_content_len, report.matched_item) == (2, 30, "关于某事的通知")


# ---------------------------------------------------------------- streams

ROWS = "seq bigint, source_url string, title string, content string"


def test_stream_of_batches_equals_one_upsert(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    batches = [[(0, "a", "A", "1"), (1, "b", "B", "1"), (2, "a", "A2", "2")], [(3, "b", "B2", "3"), (4, "c", None, "x")], [(5, "c", "C", "y")]]
    for rows in batches:
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ROWS).parquet(src)
        streaming.start_ingest(stream, out, state).awaitTermination()
    got = streaming.current_rows(streaming.read_changes(spark, out))
    assert sorted((r.source_url, r.title, r.content, r.first_seq) for r in got.collect()) == [("a", "A2", "2", 0), ("b", "B2", "3", 1), ("c", "C", "y", 5)]
    nothing = spark.createDataFrame([], "id bigint, source_url string, title string, content string, created_at timestamp, updated_at timestamp")
    once = upsert.upsert(nothing, spark.createDataFrame([r for b in batches for r in b], ROWS), F.current_timestamp())
    same = lambda df: sorted((r.source_url, r.title, r.content) for r in df.collect())
    assert same(got) == same(once)
    b = got.where("source_url = 'b'").collect()[0]
    assert b.created_at < b.updated_at and b.changes == 2
    # A batch that runs again replaces itself.
    redo = spark.createDataFrame(batches[1], ROWS).withColumn("received_at", F.current_timestamp())
    streaming.write_changes(redo, 1, out)
    assert same(streaming.current_rows(streaming.read_changes(spark, out))) == same(once)
    streaming.compact(spark, out, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3


def test_late_rows_are_dropped_and_undated_rows_are_kept(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    for rows in ([("a", "2026-08-01"), ("a", "2026-08-01"), ("n", "")], [("b", "2026-08-30"), ("a", "2026-08-02")], [("late", "2026-08-03"), ("c", "2026-08-29"), ("m", "bad")]):
        spark.createDataFrame(rows, "source_url string, date string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("source_url string, date string").parquet(src)
        got = streaming.run_to_files(streaming.recent_distinct(stream, 7), out, state)
    assert sorted(r.source_url for r in got.collect()) == ["a", "b", "c", "m", "n"]


def test_days_are_counted_when_they_are_over(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    rows = [("2026-08-01 01:00:00",), ("2026-08-01 23:00:00",), ("2026-08-02 05:00:00",), ("2026-08-04 05:00:00",)]
    df = spark.createDataFrame(rows, "t string").select(F.to_timestamp("t").alias("created_at"))
    df.coalesce(1).write.parquet(src)
    days = streaming.run_to_files(streaming.added_per_day(spark.readStream.schema(df.schema).parquet(src)), out, state)
    assert sorted((str(r.day), r.added) for r in days.collect()) == [("2026-08-01", 2), ("2026-08-02", 1)]


# ---------------------------------------------------------------- registered queries


def test_flagship(spark):
    assert entry(spark).count() == 20


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    rows, diff = compare(spark, duck, queries()[name], oracle_sql()[name], SF)
    assert diff == ""
