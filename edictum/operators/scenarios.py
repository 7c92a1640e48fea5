"""Business scenarios: sets of keywords that tag policies."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edictum.functions.text import let
from edictum.operators.registry import literal_table
from edictum.operators.search import tags_text

# The scenarios and their keywords.
SCENARIOS = [
    {"id": "sc_license", "name": "药品经营许可审批", "keywords": ["经营许可", "许可证", "药品经营"]},
    {"id": "sc_gsp", "name": "GSP认证与飞行检查", "keywords": ["GSP", "质量管理规范", "飞行检查"]},
    {"id": "sc_insurance_point", "name": "医保定点机构申报", "keywords": ["医保定点", "定点医疗机构", "定点零售药店", "结算协议"]},
    {"id": "sc_vbp", "name": "国家药品集采参与", "keywords": ["集采", "带量采购", "中选", "集中采购"]},
    {"id": "sc_online_sales", "name": "药品网络销售合规", "keywords": ["网络销售", "处方药网络", "网售处方药", "药品网络"]},
    {"id": "sc_trace", "name": "药品追溯体系建设", "keywords": ["追溯", "追溯码", "药品信息化追溯"]},
]


def scenario_table(spark: SparkSession, scenarios: Iterable[dict] = SCENARIOS) -> DataFrame:
    return literal_table(spark, list(scenarios), "id string, name string, keywords array<string>")


def list_scenarios(scenarios: DataFrame) -> DataFrame:
    return scenarios.select("id", "name")


def searched_text(policies: DataFrame) -> Column:
    """Lower-case title, content, tags and document number."""
    parts = [F.col("title"), F.col("content"), tags_text(policies), F.col("doc_number")]
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def _holds(text: Column, keywords: Iterable[str]) -> Column:
    """One comparison with a constant per keyword, so that all of them are compiled."""
    return reduce(or_, [F.contains(text, F.lit(k.lower())) for k in keywords], F.lit(False))


def tag_scenarios(policies: DataFrame, scenarios: Iterable[dict] = SCENARIOS) -> DataFrame:
    """One row per policy and scenario it belongs to: the policy's columns and ``scenario``. No join."""
    text = F.col("_searched")
    ids = F.array_compact(F.array(*[F.when(_holds(text, s["keywords"]), F.lit(s["id"])) for s in scenarios]))
    searched = policies.withColumn("_searched", searched_text(policies))
    return searched.select(*policies.columns, F.explode(ids).alias("scenario"))


def scenario_policies(policies: DataFrame, scenario_id: str, scenarios: Iterable[dict] = SCENARIOS) -> DataFrame:
    """Policies of one scenario; an unknown scenario has none."""
    words = [k.lower() for s in scenarios if s["id"] == scenario_id for k in s["keywords"]]
    if not words:
        return policies.where(F.lit(False))
    keywords = F.array(*[F.lit(w) for w in words])
    return policies.where(let(searched_text(policies), lambda t: F.exists(keywords, lambda k: F.contains(t, k))))
