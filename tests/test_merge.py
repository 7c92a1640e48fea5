"""Upsert, run statistics, feed, numbering, files."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from edictum.operators import feed, upsert
from edictum.operators.numbering import number_rows
from edictum.schemas import FEED
from edictum.session import shared_dir
from edictum.sources import feed_files, tables

STORED = "id bigint, source_url string, title string, content string, note string, created_at timestamp, updated_at timestamp"
BATCH = "seq bigint, source_url string, title string, content string, note string"


def at(spark, text):
    return F.lit(text).cast("timestamp")


def run(spark, stored, rows, when="2026-01-02", **options):
    batch = spark.createDataFrame(rows, BATCH)
    stats = upsert.run_statistics(batch, stored).collect()[0]
    merged = upsert.upsert(stored, batch, at(spark, when), **options)
    after = upsert.assign_ids(merged, stored)
    return spark.createDataFrame(after.collect(), STORED), stats


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], STORED)


def test_insert_then_update(spark, nothing):
    once, stats = run(spark, nothing, [(0, "b", "B", "x", "n"), (1, "a", "A", "y", "n")], "2026-01-01")
    assert tuple(stats) == (2, 2, 0, "SUCCESS")
    assert sorted((r.id, r.source_url) for r in once.collect()) == [(1, "b"), (2, "a")]
    twice, stats = run(spark, once, [(0, "a", "A2", "z", "m")])
    assert tuple(stats) == (1, 0, 0, "SUCCESS")
    a = twice.where("source_url = 'a'").collect()[0]
    assert (a.id, a.title, a.content, a.note) == (2, "A2", "z", "m")
    assert str(a.created_at)[:10] == "2026-01-01" and str(a.updated_at)[:10] == "2026-01-02"
    assert twice.where("source_url = 'b'").collect()[0].title == "B"


def test_update_of_some_columns(spark, nothing):
    once, _ = run(spark, nothing, [(0, "a", "A", "x", "n")])
    twice, _ = run(spark, once, [(0, "a", "A2", "z", "m"), (1, "c", "C", "c", "k")], update_cols=("title", "content"))
    assert sorted((r.source_url, r.title, r.content, r.note) for r in twice.collect()) == [("a", "A2", "z", "n"), ("c", "C", "c", "k")]


def test_last_of_a_batch_wins_and_bad_rows_are_left_out(spark, nothing):
    rows = [(0, "a", "A", "1", ""), (1, "a", None, "2", ""), (2, "a", "A3", "3", ""), (3, None, "N", "", "")]
    after, stats = run(spark, nothing, rows)
    assert tuple(stats) == (4, 1, 2, "PARTIAL")
    assert [(r.id, r.title, r.content) for r in after.collect()] == [(1, "A3", "3")]
    bad = upsert.rejected(spark.createDataFrame(rows, BATCH))
    text = upsert.error_details(bad).collect()[0].error_details
    assert text.split("\n") == ["a: NOT NULL constraint failed: policies.title", "None: NOT NULL constraint failed: policies.source_url"]


def test_all_rejected_is_failed(spark, nothing):
    _, stats = run(spark, nothing, [(0, "a", None, "", "")])
    assert stats.status == "FAILED"


def test_error_text_is_cut_where_the_joined_text_would_be(spark):
    rows = [(i, "u" * (i % 5), "e" * (i % 3)) for i in range(4000)]
    bad = spark.createDataFrame(rows, "seq bigint, source_url string, error string")
    want = "\n".join(f"{u}: {e}" for _, u, e in rows)[:4000]
    assert upsert.error_details(bad).collect()[0].error_details == want


def test_upsert_against_a_dictionary(spark, nothing):
    rng = random.Random(5)
    stored, truth, top = nothing, {}, 0
    for round_no in range(3):
        rows = [(i, rng.choice("abcdefgh") if rng.random() < 0.6 else f"u{rng.randint(0, 40)}", rng.choice(["t", None, f"t{i}"]), str(i), "") for i in range(60)]
        stored, stats = run(spark, stored, rows)
        before = set(truth)
        for _, url, title, content, _ in rows:
            if title is not None:
                if url not in truth:
                    top += 1
                    truth[url] = [top, None, None]
                truth[url][1:] = [title, content]
        assert stats.new_added == len(set(truth) - before)
        assert {r.source_url: [r.id, r.title, r.content] for r in stored.collect()} == truth


# ---------------------------------------------------------------- numbering


def test_numbering_with_one_big_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", i * rng.choice([1, 1, 50]) * 7919 % 100003) for i in range(1, 3000)]
    rows = list({(g, o): None for g, o in rows})
    df = spark.createDataFrame(rows, "g string, o bigint")
    got = number_rows(df, "o", groups=["g"], parts=7).collect()
    want = {}
    for g in {g for g, _ in rows}:
        for n, o in enumerate(sorted(o for gg, o in rows if gg == g), 1):
            want[(g, o)] = n
    assert {(r.g, r.o): r.n for r in got} == want


def test_numbering_newest_first_with_missing_dates(spark):
    rows = [(i, None if i % 5 == 0 else f"2024-01-0{1 + i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "o bigint, d string")
    got = {r.o: r.n for r in number_rows(df, "o", descending=["d"], start=0, parts=7).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, tuple(-ord(c) for c in r[1] or ""), r[0]))
    assert got == {o: n for n, (o, _) in enumerate(want)}


def test_numbering_keeps_columns_named_like_its_own_and_takes_wide_order(spark):
    rows = [(Decimal(i * 10**20), "x" if i % 4 else None, i, -i, "b") for i in range(200)]
    df = spark.createDataFrame(rows, "o decimal(30,0), g string, part bigint, at bigint, before string")
    got = number_rows(df, "o", groups=["g"], out="first", parts=6).collect()
    assert got[0].__fields__ == ["o", "g", "part", "at", "before", "first"]
    want = {o: sum(1 for p, h, *_ in rows if h == g and p <= o) for o, g, *_ in rows}
    assert {r.o: r.first for r in got} == want
    assert number_rows(df.limit(0), "o").collect() == []


# ---------------------------------------------------------------- feed

INCOMING = "seq bigint, source_url string, title string, publish_date string, content string, issuing_authority string"


def merged(spark, existing, rows, now="2026-08-08T00:00:00"):
    return feed.merge_feed(existing, spark.createDataFrame(rows, INCOMING), F.lit(now))


def test_feed_rounds_against_a_dictionary(spark):
    rng = random.Random(9)
    existing = spark.createDataFrame([], FEED + ", pos bigint")
    truth = {}
    for round_no in range(3):
        rows = [
            (i, rng.choice(["", " ", *(f" https://a/{k}.html " for k in range(25))]), f" t{round_no}.{i}",
             rng.choice(["", "2026-08-01", "2026-08-02"]), "x" * rng.randint(0, 300), "A局 ")
            for i in range(40)
        ]
        now = f"2026-08-0{round_no + 1}"
        for _, url, title, day, content, site in rows:
            if url.strip():
                truth[url.strip()] = (title.strip(), day, content[:200], site.strip(), now)
        truth = dict(sorted(truth.items(), key=lambda kv: kv[1][1], reverse=True))
        after = feed.positioned_feed(merged(spark, existing, rows, now), parts=5)
        got = after.orderBy("pos").collect()
        assert [r.pos for r in got] == list(range(len(truth)))
        assert [(r.url, (r.title, r.publish_date, r.content_preview, r.source_site, r.created_at)) for r in got] == list(truth.items())
        assert feed.feed_audit(after, chunk=4).collect()[0].asDict() == {
            "records": len(truth), "complete": len(truth), "duplicate_urls": 0, "out_of_order": 0,
        }
        existing = spark.createDataFrame(got, after.schema)


def test_feed_keeps_ids_and_makes_stable_ones(spark):
    old = spark.createDataFrame(
        [("p_1", "旧", "https://a/1.html", "2026-08-01", "", "", "old", 0), ("", "空", "https://a/2.html", "2026-08-01", "", "", "old", 1)],
        FEED + ", pos bigint",
    )
    rows = [(0, "https://a/1.html", "新", "2026-08-02", "c", "B"), (1, "https://a/3.html", "加", "2026-08-03", "c", "B")]
    got = {r.url: r for r in merged(spark, old, rows).collect()}
    assert got["https://a/1.html"].id == "p_1" and got["https://a/1.html"].title == "新"
    assert got["https://a/2.html"].created_at == "old" and got["https://a/2.html"].id == ""  # untouched, blank as it was
    again = {r.url: r.id for r in merged(spark, old, rows).collect()}
    assert again == {u: r.id for u, r in got.items()} and len(again["https://a/3.html"]) == 14


def test_order_audit_finds_every_step_up(spark):
    rng = random.Random(2)
    days = [f"2026-01-{rng.randint(10, 28)}" for _ in range(500)]
    df = spark.createDataFrame([("i", "t", f"u{i}", d, "c", "s", "n", i) for i, d in enumerate(days)], FEED + ", pos bigint")
    want = sum(b > a for a, b in zip(days, days[1:]))
    for chunk in (1, 7, 64, 1000):
        assert feed.out_of_order(df, chunk).collect()[0].out_of_order == want


def test_feed_files(spark, tmp_path):
    lines, array = str(tmp_path / "lines"), str(tmp_path / "array")
    empty = feed_files.read_feed(spark, lines)
    assert empty.count() == 0
    assert feed_files.write_feed(merged(spark, empty, []), lines) is False
    rows = [(i, f"https://a/{i}.html", f"标题 {i}", f"2026-08-{10 + i % 9}", "c", "A") for i in range(30)]
    assert feed_files.write_feed(merged(spark, empty, rows), lines) is True
    back = feed_files.read_feed(spark, lines)
    assert back.count() == 30 and feed.feed_audit(back).collect()[0].out_of_order == 0
    assert feed_files.write_feed_array(merged(spark, back, []), array) is True
    parts = sorted((tmp_path / "array").glob("part-*"))
    whole = json.loads("".join(p.read_text(encoding="utf-8") for p in parts))
    assert len(whole) == 30 and [r["publish_date"] for r in whole] == sorted((r["publish_date"] for r in whole), reverse=True)
    one = tmp_path / "one.json"
    one.write_text("﻿" + json.dumps(whole, ensure_ascii=False), encoding="utf-8")
    assert [r.url for r in feed_files.read_feed_array(spark, str(one)).orderBy("pos").collect()] == [r["url"] for r in whole]


@pytest.mark.parametrize("text", ["不是JSON", '{"url": "x"}', '[{"url": "x"}', ""])
def test_unreadable_feed_arrays_are_empty(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text, encoding="utf-8")
    assert feed_files.read_feed_array(spark, str(path)).count() == 0


def test_unreadable_lines_are_left_out(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "part-0").write_text('{"url":"a","pos":0}\n{"url":"b"\n{"url":"c","pos":1}\n', encoding="utf-8")
    assert sorted(r.url for r in feed_files.read_feed(spark, str(tmp_path / "f")).collect()) == ["a", "c"]


# ---------------------------------------------------------------- tables


def test_tables_and_logs(spark, tmp_path):
    root = str(tmp_path / "db")
    assert tables.create_tables(spark, root) == ["policies", "crawler_logs", "attachment_text"]
    assert tables.create_tables(spark, root) == []
    batch = spark.createDataFrame([(0, "a", "A", "1", "")], BATCH)
    log = upsert.run_log(batch, tables.read_table(spark, f"{root}/policies"), "job", at(spark, "2026-01-01"), at(spark, "2026-01-02"))
    for _ in range(3):
        tables.append_log(log, f"{root}/crawler_logs")
    logs = tables.read_table(spark, f"{root}/crawler_logs")
    assert [r.id for r in upsert.last_logs(logs, 2).collect()] == [3, 2]
    first = upsert.last_logs(logs).collect()[0]
    assert (first.total_fetched, first.new_added, first.status, first.error_details) == (1, 1, "SUCCESS", "")


def test_saved_pages_and_bad_bytes(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "a.html").write_bytes("中文".encode() + b"\xff!")
    got = tables.read_saved_pages(spark, str(tmp_path / "pages")).collect()
    assert [r.html for r in got] == ["中文�!"] and got[0].url.endswith("a.html")
    assert tables.read_saved_pages(spark, str(tmp_path / "none")).count() == 0


def test_policy_snapshot(spark, tmp_path):
    rows = [(f"u{i}", f"2026-0{1 + i % 3}-01") for i in range(30)]
    df = spark.createDataFrame(rows, "source_url string, day string").withColumn("publish_date", F.to_date("day"))
    tables.write_policies(df, str(tmp_path / "p"))
    assert tables.read_table(spark, str(tmp_path / "p")).count() == 30


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_last_rows_of_a_batch_are_picked_in_place(spark):
    """Keys and positions were aggregated to know which rows stay; the rows themselves are only filtered."""
    batch = spark.createDataFrame([(0, "a", "A", "1", ""), (1, "a", "B", "2", ""), (2, "b", "C", "3", "")], BATCH)
    last = upsert.latest_per_key(batch)
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange hashpartitioning" not in plan
    assert sorted((r.source_url, r.title, r.first_seq) for r in last.collect()) == [("a", "B", 0), ("b", "C", 2)]


# ---------------------------------------------------------------- plans of the merge


def plan_of(df):
    df.collect()  # adaptive plans are final after the run
    return df._jdf.queryExecution().executedPlan().toString()


def content_lines(plan, word):
    return [line for line in plan.splitlines() if word in line and "content" in line]


def test_a_merge_neither_sorts_nor_aggregates_content(spark, monkeypatch):
    from edictum.operators import skew

    rows = [(i, f"https://a/{i % 700}", f"t{i}", "x" * 50, "n") for i in range(1500)]
    batch = spark.createDataFrame(rows, "seq bigint, source_url string, title string, content string, doc_number string")
    stored = spark.createDataFrame([(i, f"https://a/{i}", "t", "c", "n", NOW_TS, NOW_TS) for i in range(300, 2000)],
                                   "id bigint, source_url string, title string, content string, doc_number string, created_at string, updated_at string")
    want = {f"https://a/{u}": f"t{u + 1400 if u < 100 else u + 700}" for u in range(700)} | {f"https://a/{i}": "t" for i in range(700, 2000)}
    monkeypatch.setattr(skew.thin_side, "__defaults__", (10,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert.upsert(stored, batch, F.lit(NOW_TS))
        assert {r.source_url: r.title for r in merged.collect()} == want
        plan = plan_of(merged)
        for word in ("SortAggregate", "ObjectHashAggregate", "Sort ["):
            assert not content_lines(plan, word), word
        assert "ShuffledHashJoin" in plan
        table = tables.write_bucketed(stored, "policies_in_buckets", f"{shared_dir(spark)}/buckets-{random.random()}", 8)
        rest = upsert.upsert(table, batch, F.lit(NOW_TS)).where("NOT is_new AND first_seq IS NULL")
        assert rest.count() == 1300
        assert "Bucketed: true" in plan_of(rest) and not content_lines(plan_of(rest), "Exchange")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


NOW_TS = "2025-01-01 00:00:00"


def test_lookups_spread_hot_keys_as_counted(spark):
    from edictum.operators import skew

    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 7 == 0 else None if i % 50 == 1 else f"k{i}", i) for i in range(3000)]
    left = spark.createDataFrame(rows, "id bigint, k string, part bigint")
    right = spark.createDataFrame([("hot", 1), ("warm", 2), *[(f"k{i}", 100 + i) for i in range(0, 3000, 2)]], "k string, hot bigint")
    hot = {r.hot: r.parts for r in skew.hot_keys(left, "k", 64).collect()}
    assert set(hot) == {"hot", "warm"} and hot["hot"] > 20 and 4 < hot["warm"] < 10
    want = {"hot": 1, "warm": 2} | {f"k{i}": 100 + i for i in range(0, 3000, 2)}
    got = skew.lookup(left, right, "k", share=64)
    assert sorted(got.columns) == ["hot", "id", "k", "part"]
    assert {(r.id, r.k, r.part, r.hot) for r in got.collect()} == {(i, k, p, want.get(k)) for i, k, p in rows} and got.count() == 3000
    gone = skew.lookup(left, right.select("k"), "k", "left_anti", share=64)
    assert {r.id for r in gone.collect()} == {i for i, k, _ in rows if k not in want}
    assert skew.lookup(left.limit(0), right, "k").collect() == []
