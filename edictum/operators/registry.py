"""Source registry: which sites exist, how their pages are read, and how regional sites join in.

How a page is read is data, not code: each source row carries ordered extraction rules, so a new
source is a new row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edictum import schemas
from edictum.functions.text import first_nonblank, trim_u
from edictum.functions.urls import url_path
from edictum.operators.numbering import number_rows

# ---------------------------------------------------------------- fixed values: extraction rules

LI = r"(?s)<li\b[^>]*>(.*?)</li>"
ANCHOR = r'(?s)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>(.*)'
PAGE_HREF = r"(?i)\.s?html?$"
NOISE_TITLES = (
    "网站声明", "网站使用指南", "网站管理", "联系我们", "无障碍", "隐私政策",
    "站点地图", "关于我们", "免责声明", "友情链接", "更多",
)
ATTACHMENT = r'(?i)<a[^>]+href="([^"]+\.(?:pdf|docx?|zip|txt))"[^>]*>'
DOWNLOAD = r'(?i)<a[^>]+href="([^"]*downfile\.jsp[^"]*)"[^>]*>'
IMAGE = r'(?i)<img[^>]+src="([^"]+)"'

_DATE = r"([0-9]{4}[-/年.][0-9]{1,2}[-/月.][0-9]{1,2})"
LABELLED_DATE = rf"(?U)(?:发布时间|发布日期|时间)\s*[：:]\s*{_DATE}"
NEAR_LABEL_DATE = rf"发布日期[\s\S]{{0,200}}?{_DATE}"

HEADING = r"(?s)<h1[^>]*>(.*?)</h1>"
TITLE = r"(?s)<title[^>]*>(.*?)</title>"
META_TITLE = r'<meta name="ArticleTitle" content="([^"]*)"'
TITLE_BOX = r'(?s)<div class="tit">(.*?)</div>'
LABELLED_ISSUER = r"(?sU)发布机构\s*[：:]\s*</span>\s*<span[^>]*>(.*?)</span>"
ORIGIN = r"(?U)来源\s*[：:]\s*([^<\r\n]{1,60})"
WHOLE_PAGE = r"(?s)\A(.*)\z"

NHSA_ITEM_URL = r"/art/[0-9/]+art_[0-9]+_[0-9]+\.html"
NHC_ITEM_URL = r"(?U)/fzs/\w+/20[0-9]{4}/\w+\.shtml"


def cms_field(name: str) -> str:
    """Text between the begin and end markers of a CMS field."""
    return rf"(?s)<!--<\$\[{name}\]>begin-->(.*?)<!--<\$\[{name}\]>end-->"


def div_with(attribute: str, value: str, exact: bool = False) -> str:
    """First ``div`` with a class or id; it ends at the first ``</div>``."""
    around = "" if exact else r"""[^"']*"""
    return rf"""(?is)<div[^>]*{attribute}=["']{around}{re.escape(value)}{around}["'][^>]*>(.*?)</div>"""


def rule(pattern: str, min_len: int = 1, plain: bool = False) -> tuple:
    """Group 1 of ``pattern``, turned to text unless ``plain``, if it is long enough."""
    return (pattern, min_len, plain)


def content_rules(classes: Iterable[str] = (), ids: Iterable[str] = (), extra: Iterable[tuple] = ()) -> list[tuple]:
    """Containers in the order they are tried; the whole page comes last."""
    return [
        *extra,
        rule(div_with("class", "text", exact=True), 20),
        rule(div_with("id", "zoom", exact=True), 20),
        rule(div_with("class", "TRS_Editor"), 20),
        *[rule(div_with("class", c), 20) for c in classes],
        *[rule(div_with("id", i, exact=True), 20) for i in ids],
        rule(div_with("class", "article"), 50),
        rule(div_with("class", "content"), 50),
        rule(WHOLE_PAGE, 0),
    ]


_BASIC_TITLE = [rule(HEADING), rule(TITLE)]

PROFILES = {
    "nmpa": {
        "default_base": "https://www.nmpa.gov.cn",
        "item_url_re": None,
        "title_rules": _BASIC_TITLE,
        "content_rules": content_rules(),
        "doc_number_rules": [],
        "authority_rules": [],
        "date_patterns": [LABELLED_DATE],
    },
    "nhsa": {
        "default_base": "",
        "item_url_re": NHSA_ITEM_URL,
        "title_rules": [rule(cms_field("标题")), *_BASIC_TITLE],
        "content_rules": content_rules(extra=[rule(cms_field("信息内容"), 10)]),
        "doc_number_rules": [rule(cms_field("引题"))],
        "authority_rules": [rule(LABELLED_ISSUER)],
        "date_patterns": [NEAR_LABEL_DATE, LABELLED_DATE],
    },
    "nhc": {
        "default_base": "",
        "item_url_re": NHC_ITEM_URL,
        "title_rules": [rule(META_TITLE, plain=True), rule(TITLE_BOX), *_BASIC_TITLE],
        "content_rules": content_rules(ids=["xw_box"]),
        "doc_number_rules": [],
        "authority_rules": [rule(ORIGIN, plain=True)],
        "date_patterns": [LABELLED_DATE],
    },
}
PROFILES["generic"] = PROFILES["nmpa"]
RULE_COLUMNS = ["title_rules", "content_rules", "doc_number_rules", "authority_rules", "date_patterns"]

# ---------------------------------------------------------------- fixed values: national sources

NATIONAL_SOURCES = [
    {
        "id": "nmpa", "name": "国家药品监督管理局", "base": "https://www.nmpa.gov.cn",
        "list_url": "https://www.nmpa.gov.cn/xxgk/fgwj/gzwj/gzwjyp/", "parser": "nmpa",
        "keep_paths": ["/xxgk/fgwj/gzwj/gzwjyp/"], "enabled": True,
    },
    {
        "id": "nhsa", "name": "国家医疗保障局", "base": "https://www.nhsa.gov.cn",
        "list_url": "https://www.nhsa.gov.cn/col/col104/index.html", "parser": "nhsa",
        "keep_paths": ["/art/"], "enabled": True,
    },
    {
        "id": "nhc", "name": "国家卫生健康委", "base": "https://www.nhc.gov.cn",
        "list_url": "https://www.nhc.gov.cn/fzs/c100048/new_list.shtml", "parser": "nhc",
        "keep_paths": ["/fzs/"], "enabled": True,
    },
    {
        "id": "cde", "name": "国家药监局药审中心", "base": "https://www.cde.org.cn",
        "list_url": "https://www.cde.org.cn/", "parser": "generic",
        "keep_paths": [], "enabled": False,
    },
]

# ---------------------------------------------------------------- fixed values: regional navigation

CATEGORY_PARSER = {"医保局": "nhsa", "药监局": "nmpa", "卫健委": "nhc"}

AREA_CODES = {
    "国家": "cn", "北京市": "bj", "天津市": "tj", "河北省": "heb", "山西省": "sx",
    "内蒙古自治区": "nmg", "辽宁省": "ln", "吉林省": "jl", "黑龙江省": "hlj",
    "上海市": "sh", "江苏省": "js", "浙江省": "zj", "安徽省": "ah", "福建省": "fj",
    "江西省": "jx", "山东省": "sd", "河南省": "ha", "湖北省": "hb", "湖南省": "hn",
    "广东省": "gd", "广西壮族自治区": "gx", "海南省": "hi", "重庆市": "cq",
    "四川省": "sc", "贵州省": "gz", "云南省": "yn", "西藏自治区": "xz",
    "陕西省": "sn", "甘肃省": "gs", "青海省": "qh", "宁夏回族自治区": "nx",
    "新疆维吾尔自治区": "xj", "新疆生产建设兵团": "xjbt",
}


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Rows held in the query itself, so that Spark knows how few they are."""
    kind = f"array<struct<{spark.createDataFrame([], schema).schema.simpleString()[7:-1]}>>"
    return spark.sql("SELECT inline(from_json(:rows, :kind))", args={"rows": json.dumps(rows), "kind": kind})


def source_table(spark: SparkSession, sources: Iterable[dict] = NATIONAL_SOURCES) -> DataFrame:
    """Registry rows with the extraction rules of their parser filled in."""
    rows = []
    for s in sources:
        profile = PROFILES[s["parser"]]
        row = {"area": "", "portal_url": "", "item_url_re": profile["item_url_re"], **s}
        row["base"] = row["base"] or profile["default_base"]
        for column in RULE_COLUMNS:
            rules = row.get(column, profile[column])
            row[column] = [r if isinstance(r, str) else dict(zip(("pattern", "min_len", "plain"), r)) for r in rules]
        rows.append(row)
    return literal_table(spark, rows, schemas.SOURCES)


def _rule_array(rules: list) -> Column:
    if not rules:
        return F.from_json(F.lit("[]"), schemas.RULES)
    if isinstance(rules[0], str):
        return F.array(*[F.lit(p) for p in rules])
    return F.array(
        *[
            F.struct(F.lit(p).alias("pattern"), F.lit(n).alias("min_len"), F.lit(plain).alias("plain"))
            for p, n, plain in rules
        ]
    )


def with_profile(df: DataFrame, parser: str = "generic", **overrides: list) -> DataFrame:
    """Give every row the rules of one parser, e.g. for a table of pages from a single site."""
    profile = {**PROFILES[parser], **overrides}
    return df.withColumns({name: _rule_array(profile[name]) for name in RULE_COLUMNS})


def with_keep_paths(sources: DataFrame) -> DataFrame:
    """A source that names no directory keeps the directory of its list page."""
    own = F.array(url_path(F.col("list_url")))
    return sources.withColumn("keep_paths", F.when(F.size("keep_paths") > 0, F.col("keep_paths")).otherwise(own))


def merge_registries(national: DataFrame, regional: DataFrame, key: str = "id") -> DataFrame:
    """Union of two registries; the regional row wins where both have the key."""
    columns = [c for c in national.columns if c != key]
    both = national.withColumn("priority", F.lit(0)).unionByName(regional.withColumn("priority", F.lit(1)))
    return (
        both.groupBy(key)
        .agg(F.max_by(F.struct(*columns), "priority").alias("row"))
        .select(key, "row.*")
    )


def enabled_sources(sources: DataFrame) -> DataFrame:
    return sources.where("enabled")


# ---------------------------------------------------------------- regional navigation


def area_code(area: Column) -> Column:
    """Code of an area; its first two characters if it is not listed, ``xx`` if it is blank."""
    area = trim_u(F.coalesce(area, F.lit("")))
    listed = F.create_map(*[F.lit(v) for pair in AREA_CODES.items() for v in pair])
    return F.coalesce(
        F.try_element_at(listed, area), F.nullif(F.lower(F.substring(area, 1, 2)), F.lit("")), F.lit("xx")
    )


def regional_sources(nav: DataFrame) -> DataFrame:
    """Registry rows from navigation rows (category, pos, name, area, portal_url).

    Per category the first row of a portal counts; equal ids get ``_1``, ``_2``, ... in order.
    """
    parser = F.create_map(*[F.lit(v) for pair in CATEGORY_PARSER.items() for v in pair])
    portal = F.rtrim(F.coalesce(F.col("portal_url"), F.lit("")), F.lit("/"))
    first = (
        nav.where(F.col("category").isin(*CATEGORY_PARSER))
        .withColumn("portal", portal)
        .where("portal <> ''")
        .groupBy("category", "portal")
        .agg(F.min_by(F.struct("name", "area"), "pos").alias("row"), F.min("pos").alias("pos"))
        .select(
            F.concat_ws("_", F.try_element_at(parser, F.col("category")), area_code(F.col("row.area"))).alias("sid"),
            F.col("pos").cast("bigint").alias("pos"),
            first_nonblank(F.col("row.name")).alias("name"),
            first_nonblank(F.col("row.area")).alias("area"),
            F.concat("portal", F.lit("/")).alias("base"),
            F.try_element_at(parser, F.col("category")).alias("parser"),
        )
    )
    suffix = F.when(F.col("n") > 1, F.concat(F.lit("_"), (F.col("n") - 1).cast("string"))).otherwise(F.lit(""))
    return number_rows(first, "pos", groups=["sid"], out="n").select(
        F.concat("sid", suffix).alias("id"),
        "name",
        "area",
        "base",
        F.col("base").alias("portal_url"),
        F.lit("").alias("list_url"),
        "parser",
        F.array().cast("array<string>").alias("keep_paths"),
        F.lit(False).alias("enabled"),
    )
