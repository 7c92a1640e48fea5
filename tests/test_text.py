import html
import random
import re

from pyspark.sql import functions as F

from edictum.functions import dates, text

V = F.col("v")


def test_paragraphs_stay_apart(values):
    raw = "<div class='content'><p>第一段内容。</p><p>第二段内容。</p></div>"
    assert values(text.clean_html_text(V), [raw]) == ["第一段内容。\n第二段内容。"]


def test_inline_markup_vanishes(values):
    assert values(text.clean_html_text(V), ["<p>带<b>加粗</b>与<a href='x'>链接</a>的正文</p>"]) == ["带加粗与链接的正文"]


def test_blank_runs_between_tags_vanish_but_not_inside_text(values):
    raws = ["<b>a</b> <i>b</i> c", "<td>&nbsp;</td><td>x</td>", "a <i>b</i> c", "<p>x</p>\n   \n<p>y</p>"]
    assert values(text.clean_html_text(V), raws) == ["ab c", "x", "a b c", "x\ny"]


def test_markup_that_is_no_markup(values):
    raws = ["a < b and c > d", "<p title='x>y' q=\"z>\">k</p>", "<p don't>it</p><p>isn't</p>", "tail <a href="]
    assert values(text.clean_html_text(V), raws) == ["a < b and c > d", "k", "it\nisn't", "tail"]


def test_comments_scripts_and_double_decoding(values):
    raws = ["x<!-- <p> -->y", "a<script>if (b < '</p>') {}</script>c", "&amp;lt;q&amp;gt; &amp;amp;lt;"]
    assert values(text.clean_html_text(V), raws) == ["xy", "ac", "<q> &lt;"]
    kept = values(text.clean_html_text(V, drop_script=False), ["a<script>if (b < '</p>') {}</script>c"])
    assert kept == ["aif (b < '</p>') {}c"]


def test_blank_and_missing_html(values):
    assert values(text.clean_html_text(V), ["", None, "<p></p>", "　\t "]) == ["", "", "", ""]


def test_entities_match_the_standard_table(values):
    rng = random.Random(7)
    names = list(html.entities.html5)
    raws = ["&" + n for n in names]
    raws += [f"&#{n};" for n in [0, 1, 9, 13, 65, 128, 129, 150, 159, 0xD800, 0xFDD0, 0xFFFE, 0x1F600, 0x110000, 10**12]]
    raws += ["&#x4E2d;&#X41", "AT&T", "&", "&&&amp&", "&copyx", "&notit;", "&nope;", "&#;", "&#x;", "&amp;lt;", "a&b;c&lt"]
    raws += ["".join(rng.choice(["&", "#", "x", "1", "amp", "lt;", ";", "é", " ", "中", "copy"]) for _ in range(12)) for _ in range(300)]
    assert values(text.unescape(V), raws) == [html.unescape(r) for r in raws]


def test_scrubbing(values):
    raws = [
        "身份证号：110101199001011234 已登记",
        "联系电话 13812345678 请查收",
        "电话 010-12345678",
        "11010119900101123X，13912345678。",
        "1101011990010112345",
        "x138123456789",
    ]
    assert values(text.scrub_pii(V), raws) == [
        "身份证号：[身份证号已脱敏] 已登记",
        "联系电话 [手机号已脱敏] 请查收",
        "电话 010-12345678",
        "[身份证号已脱敏]，[手机号已脱敏]。",
        "1101011990010112345",
        "x138123456789",
    ]


def test_document_numbers(values):
    raws = ["现发布《指导原则》。国药监药管〔2026〕18号，自发布之日起施行。", "见　药审业〔 2026 〕250号", "（2026）1号", "国" * 40 + "〔2026〕1号", ""]
    assert values(text.doc_number(V), raws) == ["国药监药管〔2026〕18号", "药审业〔 2026 〕250号", "", "国" * 30 + "〔2026〕1号", ""]


def test_document_numbers_against_a_plain_search(values):
    rng = random.Random(3)
    parts = ["国", "药", " ", "　", "，", "〔", "(", "2026", "〕", ")", "18", "号", "字", "\U0001f600", "\n"]
    raws = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    raws += ["".join(rng.choice(["国", "，", "〔2026〕", "号", "(2024)1号"]) for _ in range(rng.randint(1, 50))) for _ in range(500)]
    plain = re.compile(r"[^\s，。；、]{0,30}?[〔(]\s*\d{4}\s*[〕)][^\s，。；、]{0,20}?号")
    found = [plain.search(r) for r in raws]
    assert values(text.doc_number(V), raws) == [m.group(0).strip() if m else "" for m in found]


def test_json_lists_are_lenient(values):
    raws = ['[{"url":"a","file":"b"}]', '{"url":1}', "x", None, '[{"url":"a"', "[]"]
    got = values(F.size(text.json_list(V)), raws)
    assert got == [1, 0, 0, 0, 0, 0]


def test_like_wildcards_and_backslash(values):
    raws = ["100% GSP", "gsp", "a_b", "axb", "c\\d"]
    assert values(text.like_contains(V, "gsp"), raws) == [True, True, False, False, False]
    assert values(text.like_contains(V, "a_b"), raws) == [False, False, True, True, False]
    assert values(text.like_contains(V, "c\\d"), raws) == [False, False, False, False, True]


def test_dates(values):
    raws = ["2024-00-00012 x 2026年7月5日", "2026-02-00018", "2026.12.31", "", "2026-13-2026-01-02"]
    assert values(text.first_nonblank(dates.first_valid_date(V)), raws) == ["2026-07-05", "", "2026-12-31", "", ""]


def test_recency(values):
    raws = ["2026-08-01", "2026-07-31", "", "2026-02-31", "2026-09-01", "soon", None]
    assert values(dates.is_recent(V, 7, "2026-08-08"), raws) == [True, False, True, True, True, True, True]
    assert values(dates.is_recent(V, 0, "2026-08-08"), raws) == [True] * 7


def test_validity(values):
    status = lambda title: dates.validity_status(F.lit(title), V, "2026-08-08")
    assert values(status("通知"), ["2026-08-18", "2026-01-01", "", "bad", None]) == ["未生效", "有效", "有效", "有效", "有效"]
    assert values(status("关于废止办法的通知"), ["2026-01-01"]) == ["废止"]
    assert values(status("已失效"), ["2030-01-01"]) == ["废止"]


def test_clamping(values):
    raws = ["5", "abc", "999", "-3", None, " 7 "]
    assert values(dates.clamp_int(V, 20, 1, 100), raws) == [5, 20, 100, 1, 20, 7]
    assert [dates.clamp(r, 20, 1, 100) for r in raws] == [5, 20, 100, 1, 20, 7]


def test_scrubbing_finds_what_it_found_at_every_place(values):
    """The masks look behind the first character of a number; what they find is what looking behind each place finds."""
    rng = random.Random(8)
    raws = ["".join(rng.choices("1389٣Xx a", [6, 3, 3, 1, 1, 1, 1, 1, 1], k=rng.randint(9, 60))) for _ in range(3000)]
    raws += ["1" * n for n in range(8, 40)] + ["13" + "8" * 9, "x13" + "8" * 9 + "y", "0" + "13" + "8" * 9, "2" * 17 + "X"]
    want = [re.sub(r"(?<!\d)1[3-9]\d{9}(?!\d)", text.MOBILE_MASK, re.sub(r"(?<!\d)\d{17}[\dXx](?!\d)", text.ID_CARD_MASK, r)) for r in raws]
    assert values(text.scrub_pii(V), raws) == want and sum(w != r for w, r in zip(want, raws)) > 100


def test_pages_are_scanned_no_more_than_needed(spark):
    """One pattern scan finds a document number, and blanks that stand alone are not replaced."""
    plan = spark.range(1).select(text.doc_number(F.col("id").cast("string")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\d{4}") == 1
    text_of = spark.range(1).select(text.clean_html_text(F.lit("a b  c \u3000d\te\u3000f <b>g</b> h")).alias("t")).first().t
    assert text_of == "a b c d e f g h"
    assert "{2,}|" in str(text.clean_html_text(F.col("v"))._jc)
