"""List and document pages; the page strings are written for these tests."""

import pytest
from pyspark.sql import functions as F

from edictum.operators import details, listing, registry

LISTS = {
    "nmpa": """<ul><li><span class="date">(2025-11-06)</span><a href="/xxgk/fgwj/gzwj/gzwjyp/lk17a.html">冷库验证报告填写的说明</a></li>
      <li><a href="./lk17b.html" target="_blank">关于冷藏车备案换发的通知</a><span>2025年10月9日</span></li></ul>
      <div><a href="/site.html">网站声明</a></div><li><a href="/about.html">联系我们</a></li>""",
    "nhsa": """<li><span>2025-09-00031</span><a title="t" href="/art/2025/9/3/art_88_30915.html">关于更换窗口叫号设备的通知</a>
      <span>医保办函〔2025〕77号</span><span>2025-09-03</span></li><li><a href="/col/col1/index.html">政策法规栏目</a></li>
      <li><a href="/art/2025/9/2/art_88_1.html">更多通知公告</a></li>""",
    "nhc": """<li><a href="/fzs/c1/202512/nm.shtml">关于调整夜间门诊的通告</a><i>2025.12.03</i></li>
      <li><a href="/fzs/c1/new_list.shtml">政策文件列表</a></li><li><a href="/fzs/c1/202511/q.shtml">短</a></li>
      <li>无链接 2025-02-02</li><li><a href="/fzs/c1/202510/e.shtml">没有日期的一条政策</a> 2025-17-40</li>""",
}
DETAILS = {
    "nmpa": """<html><head><title>站名</title></head><body><h1>冷库验证<b>说明</b></h1><p>发布时间：2025-11-6</p>
      <div class="text">短</div><div class='TRS_Editor x'><p>国药监药管〔2025〕94号</p><p>冷库每年至少验证一次，验证报告由使用单位存档五年备查。</p></div>
      <a href="../att/a.PDF">附件</a><a href="../att/a.PDF">again</a><img src="i.png"></body></html>""",
    "nhsa": """<title>t</title><!--<$[标题]>begin-->城北大厅 更换说明<!--<$[标题]>end--><!--<$[引题]>begin-->医保办函〔2025〕77号<!--<$[引题]>end-->
      <td>发布日期</td><td> 2025-09-03 </td><span>发布机构：</span> <span class="v">城北经办大厅</span>
      <!--<$[信息内容]>begin--><p>表格请在下面取用。</p><a href="/m/downfile.jsp?k=9&amp;n=4">下载</a><!--<$[信息内容]>end-->""",
    "nhc": """<meta name="ArticleTitle" content=" 关于夜间门诊的通告 "><title>x</title><div class="tit">other</div>
      <p>时间: 2025-12-03</p><span>来源：
        门诊办</span><div id="xw_box"><p>国卫通〔2025〕63号</p><p>夜间门诊自下月起延长两小时，周末同样开放。</p></div><script>$(function(){})</script>""",
}


@pytest.fixture(scope="module")
def sources(spark):
    return registry.source_table(spark)


def list_rows(spark, sources):
    pages = spark.createDataFrame(
        [(i, s, "", h) for i, (s, h) in enumerate(LISTS.items())], "page_id bigint, source string, base string, html string"
    )
    return listing.parse_list_pages(pages, sources)


def test_lists_of_three_sites(spark, sources):
    got = [(r.source, r.url, r.title, r.date) for r in list_rows(spark, sources).orderBy("page_id", "pos").collect()]
    assert got == [
        ("nmpa", "https://www.nmpa.gov.cn/xxgk/fgwj/gzwj/gzwjyp/lk17a.html", "冷库验证报告填写的说明", "2025-11-06"),
        ("nhsa", "https://www.nhsa.gov.cn/art/2025/9/3/art_88_30915.html", "关于更换窗口叫号设备的通知", "2025-09-03"),
        ("nhc", "https://www.nhc.gov.cn/fzs/c1/202512/nm.shtml", "关于调整夜间门诊的通告", "2025-12-03"),
        ("nhc", "https://www.nhc.gov.cn/fzs/c1/202510/e.shtml", "没有日期的一条政策", ""),
    ]


def test_relative_links_need_their_page_as_base(spark, sources):
    base = "https://www.nmpa.gov.cn/xxgk/fgwj/gzwj/gzwjyp/index.html"
    pages = spark.createDataFrame([(0, "nmpa", base, LISTS["nmpa"])], "page_id bigint, source string, base string, html string")
    got = listing.parse_list_pages(pages, sources).orderBy("pos").collect()
    assert [(r.url[-11:], r.date) for r in got] == [("/lk17a.html", "2025-11-06"), ("/lk17b.html", "2025-10-09")]


def test_first_items_of_a_hot_source(spark):
    rows = [(p, i, "hot" if p % 3 else "cold", "u", "t", "") for p in range(120) for i in range(12)]
    items = spark.createDataFrame(rows, "page_id bigint, pos int, source string, url string, title string, date string")
    for n in (7, 101, 1001):
        want = []
        for s in ("hot", "cold"):
            want += sorted((r[0], r[1], s) for r in rows if r[2] == s)[:n]
        got = listing.first_items(items, n).select("page_id", "pos", "source").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def record(spark, sources, source, html=None):
    pages = spark.createDataFrame([(source, "https://h.cn/a/b/c.html", html or DETAILS[source])], "source string, url string, html string")
    return details.parse_documents(pages, sources).collect()[0]


def test_basic_document(spark, sources):
    r = record(spark, sources, "nmpa")
    assert (r.title, r.publish_date, r.doc_number, r.issuing_authority) == ("冷库验证说明", "2025-11-06", "国药监药管〔2025〕94号", "")
    assert r.content == "国药监药管〔2025〕94号\n冷库每年至少验证一次，验证报告由使用单位存档五年备查。"
    assert [a.url for a in r.attachments] == ["https://h.cn/a/att/a.PDF"]
    assert [a.url for a in r.images] == ["https://h.cn/a/b/i.png"]
    assert r.raw_html == DETAILS["nmpa"] and r.implement_date == ""


def test_marked_document(spark, sources):
    r = record(spark, sources, "nhsa")
    assert (r.title, r.publish_date, r.doc_number) == ("城北大厅 更换说明", "2025-09-03", "医保办函〔2025〕77号")
    assert r.issuing_authority == "城北经办大厅"
    assert "表格请在下面" in r.content
    assert [a.url for a in r.attachments] == ["https://h.cn/m/downfile.jsp?k=9&n=4"]


def test_document_with_meta_title(spark, sources):
    r = record(spark, sources, "nhc")
    assert (r.title, r.publish_date, r.doc_number) == ("关于夜间门诊的通告", "2025-12-03", "国卫通〔2025〕63号")
    assert r.issuing_authority == "门诊办"
    assert "$(function" not in r.content and "夜间门诊自下月起" in r.content


def test_whole_page_when_no_container_is_long_enough(spark, sources):
    r = record(spark, sources, "nmpa", '<div class="text">短</div><p>其余</p>')
    assert r.content == "短\n其余"


def test_a_new_site_is_a_row(spark):
    own = {
        "id": "new", "name": "新", "base": "https://n.cn", "list_url": "https://n.cn/l/", "parser": "generic",
        "keep_paths": [], "enabled": True, "content_rules": registry.content_rules(classes=["my-box"]),
    }
    sources = registry.source_table(spark, [own])
    r = record(spark, sources, "new", '<h1>题目</h1><div class="a my-box b">' + "正文" * 20 + "</div>尾")
    assert r.content == "正文" * 20


def test_unknown_sources(spark, sources):
    pages = spark.createDataFrame([(1, "nmpa"), (2, "zzz")], "page_id bigint, source string")
    assert [r.page_id for r in listing.unknown_sources(pages, sources).collect()] == [2]


def test_page_parsing_needs_no_shuffle(spark, sources):
    pages = spark.createDataFrame([("nmpa", "u", "h")], "source string, url string, html string")
    plan = details.parse_documents(pages, sources)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_titles_of_items_as_text(spark):
    pages = spark.createDataFrame([(0, "s", "https://h.cn/", '<li><a href="a.html">&nbsp;<b>通知</b> &amp; 公告</a></li>')], "page_id bigint, source string, base string, html string")
    assert [r.title for r in listing.list_items(pages).collect()] == ["通知 & 公告"]
    assert listing.tsv_lines(listing.list_items(pages)).columns == ["date", "title", "url"]
    assert listing.list_items(pages).select(F.size(F.array("url"))).count() == 1


def test_item_order_takes_any_page_id_and_any_position(spark):
    rows = [(2**62 + 1, 0), (2**62, 3_000_000), (-5, 1), (2**62, 2)]
    df = spark.createDataFrame(rows, "page_id bigint, pos int").withColumn("seq", listing.item_order())
    assert [tuple(r)[:2] for r in df.orderBy("seq").collect()] == sorted(rows)
