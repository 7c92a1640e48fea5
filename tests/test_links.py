"""Links between items and documents, enrichment."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from edictum.operators import containment, enrichment, linkage
from edictum.operators.registry import source_table

ITEMS = "page_id bigint, pos int, source string, url string, title string, date string"
DOCS = """page_id bigint, source string, url string, title string, publish_date string, implement_date string, doc_number string,
 issuing_authority string, content string, raw_html string, attachments array<struct<url:string>>, images array<struct<url:string>>"""


def doc(i, source, url, title, who="", day=""):
    return (i, source, url, title, day, "", f"号{i}", who, f"正文{i}", "<html>", [(f"{url}/a.pdf",)], [])


def test_blank_document_fields_fall_back_to_the_item(spark):
    items = spark.createDataFrame([(1, 0, "nhc", "u1", "条目", "2026-01-01"), (1, 1, "nhc", "u2", "无页", "2026-01-02")], ITEMS)
    docs = spark.createDataFrame([doc(1, "nhc", "u1", "")], DOCS)
    r = linkage.link_by_url(items, docs.drop("source", "page_id"), source_table(spark)).collect()
    assert [(x.title, x.publish_date, x.issuing_authority, x.doc_number) for x in r] == [("条目", "2026-01-01", "国家卫生健康委", "号1")]
    assert [x.url for x in linkage.unread_items(items, docs).collect()] == ["u2"]


def brute_matches(items, docs):
    found = {}
    for d in docs:
        title = d[3].strip()
        for it in sorted(items, key=lambda i: (i[0], i[1])):
            t = it[4].strip()
            if title and t and it[2] == d[1] and (title in t or t in title):
                found[d[2]] = it[3]
                break
    return found


def test_title_containment_against_all_pairs(spark):
    rng = random.Random(11)
    words = ["国家", "药监局", "关于", "通知", "a", "ab", "\U0001f600", " ", "的", "2026"]
    title = lambda n: "".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    items = [(p, i, rng.choice(["s", "s", "s", "q"]), f"i{p}.{i}", title(14), "") for p in range(40) for i in range(4)]
    items += [(90, 0, "s", "long", title(400), "")]
    docs = [doc(i, rng.choice(["s", "s", "q", "none"]), f"d{i}", title(rng.choice([2, 5, 12, 500]))) for i in range(120)]
    got = linkage.match_titles(spark.createDataFrame(items, ITEMS), spark.createDataFrame(docs, DOCS)).collect()
    want = brute_matches(items, docs)
    assert {r.url: r.item_url for r in got} == want and len(got) == len(want) > 40


def test_long_titles_are_looked_up_at_few_places(spark):
    """Copies of every length, also periodic ones, within long titles; only chosen places of these are dealt out."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh药品 ") for _ in range(rng.randint(2, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    titles = [line(rng.choice([1, 3, 8, 20, 150])) for _ in range(150)] + ["The " * n for n in (3, 40, 90)] + ["ab" * 300]
    docs = [doc(i, "s", f"d{i}", t) for i, t in enumerate(titles)]
    items = []
    for i, t in enumerate(titles):
        a = rng.randrange(len(t))
        b = rng.randint(a + 1, len(t))
        items.append((i, 0, "s", f"i{i}", t[a:b] if i % 2 else f"{line(2)}{t}{line(90)}", ""))
    got = linkage.match_titles(spark.createDataFrame(items, ITEMS), spark.createDataFrame(docs, DOCS)).collect()
    want = brute_matches(items, docs)
    assert {r.url: r.item_url for r in got} == want and len(got) == len(want) > 140

    texts = spark.createDataFrame([("s", t, i) for i, t in enumerate(titles)], "grp string, text string, id bigint")
    widths = spark.createDataFrame([("s", 24), ("s", 8)], "grp string, k int")
    assert linkage._anchors(texts, widths).count() < 0.5 * sum(map(len, titles))


def test_link_by_title_gives_the_document_to_the_matched_row_only(spark):
    items = spark.createDataFrame([(1, 0, "nhsa", "u1", "关于某事的通知", "2026-01-01"), (1, 1, "nhsa", "u2", "另一通知", "")], ITEMS)
    docs = spark.createDataFrame([doc(5, "nhsa", "d1", "国家局关于某事的通知全文", "办公厅"), doc(6, "nhsa", "d2", "")], DOCS)
    got = {r.source_url: r for r in linkage.link_by_title(items, docs, source_table(spark)).collect()}
    assert (got["u1"].content, got["u1"].doc_number, len(got["u1"].attachments)) == ("正文5", "号5", 1)
    assert (got["u2"].content, got["u2"].doc_number, got["u2"].attachments) == ("", "", [])
    assert {r.issuing_authority for r in got.values()} == {"办公厅"}


def test_titles_are_never_compared_pair_by_pair(spark):
    items = spark.createDataFrame([(1, 0, "s", "u", "t", "")], ITEMS)
    plan = linkage.match_titles(items, spark.createDataFrame([doc(1, "s", "d", "t")], DOCS))._jdf.queryExecution()
    assert "NestedLoop" not in plan.toString() and "Cartesian" not in plan.toString()


def test_places_of_titles_are_not_rows(spark):
    """Titles are searched in arrays; before, each place of a title was a row that was dealt out."""
    docs = spark.createDataFrame([doc(i, "s", f"d{i}", f"关于印发第{i}号文件的通知") for i in range(9)], DOCS)
    items = spark.createDataFrame([(1, i, "s", f"u{i}", f"第{i}号文件", "") for i in range(9)], ITEMS)
    matched = linkage.match_titles(items, docs)
    assert "explode" not in matched._jdf.queryExecution().toString()
    assert sorted((r.url, r.item_url) for r in matched.collect()) == [(f"d{i}", f"u{i}") for i in range(9)]


def test_held_texts_against_all_pairs(spark):
    """Tiny blocks, filters that are too small, several rounds, and beginnings that all texts share."""
    rng = random.Random(13)
    words = ["国家", "药监局", "关于发布", "通知", "a", "ab", "The ", "\U0001f600", " ", "é", "2026年第1号公告"]
    made = lambda n: "".join(rng.choice(words) for _ in range(n))
    texts = {made(rng.choice([1, 1, 2, 3, 6, 15, 60])) for _ in range(180)} | {"国家药品监督管理局关于发布" + made(2) for _ in range(60)}
    texts |= {"ab" * n for n in (1, 7, 8, 200)} | {"e", "x" * 4000 + made(3)}
    rows = [(g, t) for t in sorted(texts) for g in rng.choice([["s"], ["q"], ["s", "q"]])]
    df = spark.createDataFrame(rows, "grp string, t string").withColumn("key", F.unhex(F.md5("t")))
    of = {hashlib.md5(t.encode()).digest(): t for t in texts}
    want = sorted((g, a, b) for g, a in rows for h, b in rows if g == h and a != b and b in a)
    assert len(want) > 1000
    for options in ({}, {"block": 100}, {"most": 100}, {"words": 16}):
        found = containment.held_texts(df, ["grp", "key"], **options).collect()
        pairs = [(r.grp, of[bytes(r.key)], of.get(bytes(r.held))) for r in found]
        known = [p for p in pairs if (p[0], p[2]) in set(rows)]
        assert sorted(known) == want
        assert len(pairs) < 1.2 * len(want) or options  # a filter of its size is seldom mistaken
    assert containment.held_texts(df.limit(0), ["key"]).count() == 0


def exchanged(df):
    """What each exchange of a plan deals out."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\(\d+\) Exchange\nInput[^:]*: (.*)", plan)


def test_contents_are_dealt_out_once(spark):
    """A document twice, two of one URL, two for one row: the first by page_id and URL gives all fields."""
    docs = [doc(7, "s", "d1", "关于甲的通知"), doc(5, "s", "d1", "关于甲的通知"), doc(5, "s", "d1", "关于甲的通知"), doc(6, "s", "d0", "甲的通知"), doc(9, "s", "d9", "无")]
    items = spark.createDataFrame([(1, 0, "s", "u", "关于甲的通知全文", ""), (2, 0, "s", "u", "同一地址", ""), (3, 0, "s", "v", "乙", "")], ITEMS)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        linked = linkage.link_by_title(items, spark.createDataFrame(docs, DOCS), source_table(spark))
        heavy = [e for e in exchanged(linked) if re.search(r"\b(content|doc|min_by|minby)#|valueWithOrdering#", e)]
        assert len(heavy) == 1
        got = sorted((r.page_id, r.doc_number, r.content) for r in linked.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert got == [(1, "号5", "正文5"), (2, "号5", "正文5"), (3, "", "")]


def test_rows_without_a_document_are_dealt_out_by_their_own_url(spark):
    """Items named like a document's URL, or like nothing: none takes fields, and they meet contents in many tasks."""
    items = spark.createDataFrame([(i, 0, "s", f"u{i}", f"甲{i}", "") for i in range(64)] + [(99, 0, "s", "d1", "无文", "")], ITEMS)
    docs = spark.createDataFrame([doc(1, "s", "d1", "乙通知"), doc(2, "s", "d2", "甲7")], DOCS)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        linked = linkage.link_by_title(items, docs, source_table(spark)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held[0])
        spark.conf.set("spark.sql.adaptive.enabled", held[1])
    assert [r.page_id for r in linked if r.content] == [7]
    assert len({r.task for r in linked}) > 4


# ---------------------------------------------------------------- enrichment

POLICY = "source_url string, content string, attachments array<struct<url:string,file:string>>, images array<struct<url:string>>"


def enrich(spark, content, attachments=(), images=(), texts=()):
    df = spark.createDataFrame([("k", content, list(attachments), [(i,) for i in images])], POLICY)
    table = spark.createDataFrame(list(texts), "url string, kind string, text string")
    return enrichment.enrich_content(df, table).collect()[0].content


def test_short_content_gains_all_attachments_in_order(spark):
    links = [("b.pdf", "f"), ("a.PDF", ""), ("w.docx", ""), ("v.doc", "f"), ("x.zip", "f"), ("none.pdf", "f")]
    texts = [("a.PDF", "doc", " A "), ("b.pdf", "doc", "B"), ("w.docx", "doc", "W"), ("v.doc", "doc", "V"), ("x.zip", "doc", "X"), ("none.pdf", "doc", " ")]
    assert enrich(spark, "简短", links, (), texts) == "简短\n[附件] B\n[附件] A\n[附件] V"


def test_image_text_comes_last_and_only_if_still_short(spark):
    texts = [("a.pdf", "doc", "甲" * 120), ("1.png", "image", " "), ("2.png", "image", "图"), ("3.png", "image", "另")]
    images = ["1.png", "2.png", "3.png"]
    assert enrich(spark, "短", (), images, texts) == "短\n[图片OCR] 图"
    assert "OCR" not in enrich(spark, "短", [("a.pdf", "")], images, texts)


def test_long_content_is_left_alone(spark):
    assert enrich(spark, "长" * 100, [("a.pdf", "f")], ["1.png"], [("a.pdf", "doc", "A"), ("1.png", "image", "B")]) == "长" * 100
    assert enrich(spark, " 短 ", [("a.pdf", "f")], ["1.png"]) == " 短 "
    assert enrich(spark, "", [("a.pdf", "f")], [], [("a.pdf", "doc", "A")]) == "[附件] A"


def test_preparation_masks_after_the_status_is_set(spark):
    df = spark.createDataFrame([("关于废止13812345678", "证110101199001011234号", "2026-01-01", "<p>13812345678")], "title string, content string, publish_date string, raw_html string")
    r = enrichment.prepare_policies(df, "2026-08-08").collect()[0]
    assert r.validity_status == "废止" and "138" not in r.title + r.content + r.raw_html and "1101" not in r.content
    kept = enrichment.prepare_policies(df, "2026-08-08", scrub=False).collect()[0]
    assert "13812345678" in kept.title
    assert df.select(F.length("title")).count() == 1
