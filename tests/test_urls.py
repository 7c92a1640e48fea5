import itertools
from urllib.parse import urljoin, urlsplit

from pyspark.sql import functions as F

from edictum.functions import urls

BASES = [
    "https://www.x.cn", "https://www.x.cn/", "https://www.x.cn/a/b/c.html", "https://www.x.cn/a/b/?q=1#z",
    "http://h:80/a/./b/../c/d?x=1", "https://www.x.cn/a//b/c", "",
]
HREFS = [
    "", "a.html", "./a.html", "../a.html", "../../a.html", "../../../../a.html", "/r/s.html", "//other.cn/x/y",
    "http://z.cn", "HTTPS://z.cn/?", "?k=2", "#f", "a/b/../c", "..", ".", "a/..", "/a/../../b", "/a//b", "a//b//c",
    "mailto:x@y", "javascript:void(0)", "ftp://q/w", "https://www.x.cn/p?#", "a?x#y", "x/./y/", "/", "./",
    "https:foo/bar", "中 文.html", "...", "/.", "/..", "a/.", "http://z.cn/a/../b",
]


def test_resolution_matches_the_standard_library(spark):
    pairs = list(itertools.product(BASES, HREFS))
    df = spark.createDataFrame(pairs, "base string, href string")
    got = df.select("base", "href", urls.resolve_url(F.col("base"), F.col("href")).alias("url")).collect()
    assert [(r.base, r.href, r.url) for r in got] == [(b, h, urljoin(b, h)) for b, h in pairs]


def test_parts(values):
    raws = ["https://a.cn/x/y?q#f", "http://a.cn:80", "https://中.cn/ü b/", "https://a.cn?q=/z"]
    assert values(urls.url_host(F.col("v")), raws) == [urlsplit(r).netloc for r in raws]
    assert values(urls.url_path(F.col("v")), raws) == [urlsplit(r).path for r in raws]
    assert values(urls.url_path(F.col("v"), root=True), raws) == [urlsplit(r).path or "/" for r in raws]


def test_attachment_names(values):
    raws = ["https://x/a%20b.pdf", "https://x/", "https://x/%zz", "https://x/a+b.pdf", "https://x/%E6%96%87.doc"]
    assert values(urls.attachment_name(F.col("v")), raws) == ["a b.pdf", "file", "file", "a+b.pdf", "文.doc"]


def test_references_of_one_page_resolve_as_one_by_one(spark):
    df = spark.createDataFrame([(b, HREFS) for b in BASES], "base string, hrefs array<string>")
    got = df.select("base", urls.resolve_urls(F.col("base"), F.col("hrefs")).alias("urls")).collect()
    assert [(r.base, r.urls) for r in got] == [(b, [urljoin(b, h) for h in HREFS]) for b in BASES]
