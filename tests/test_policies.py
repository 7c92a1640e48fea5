"""Search, scenarios, statistics on policies made up here, with equal and missing dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from edictum.operators import enrichment, scenarios, search, stats
from edictum.operators.registry import source_table
from edictum.schemas import POLICIES

TODAY = dt.date(2025, 4, 2)


@pytest.fixture(scope="module")
def policies(spark):
    at = dt.datetime(2025, 4, 2, 7)

    def row(i, title, number, who, day, content, tags):
        return (i, title, number, who, day, None, "有效", f"https://y.example.cn/{i}.html", content, [], tags, at, at)

    rows = [
        row(1, "第七批耗材带量采购中选名单公示", "采办〔2025〕31号", "云州采购中心", dt.date(2025, 3, 4), "中选企业请于月底前签约", ["耗材"]),
        row(2, "门店冷链温度记录抽查办法", "", "云州药监分局", dt.date(2025, 3, 4), "药品追溯码须逐盒上传", ["冷链", "抽查"]),
        row(3, "停诊安排", "", "", None, "", []),
        row(4, "执业药师学分说明", "云药教〔2024〕7号", "云州药监分局", dt.date(2024, 11, 30), "GSP 培训计入学分", ["培训"]),
        row(5, "旧版收费目录", "", "云州医保中心", None, "仅供查阅", []),
    ]
    return spark.createDataFrame(rows, POLICIES)


def ids(df):
    return [r.id for r in df.collect()]


@pytest.mark.parametrize(
    "filters, expected",
    [
        ({"keyword": "中选"}, [1]), ({"keyword": " gsp "}, [4]), ({"keyword": "〔2024〕"}, [4]), ({"authority": "药监"}, [2, 4]),
        ({"tag": "抽"}, [2]), ({"exact_tag": "抽"}, []), ({"exact_tag": "抽查"}, [2]), ({"status": "废止"}, []),
        ({"date_from": "2025-01-01", "date_to": "2025-12-31"}, [1, 2]), ({"date_to": "2024-12-31"}, [3, 4, 5]),
        ({"date_from": "2025-03"}, [1, 2]), ({"date_from": "2025-02-30"}, [1, 2]), ({"date_to": "2024-13-01"}, [3, 4, 5]),
        ({"keyword": "", "authority": "  "}, [1, 2, 3, 4, 5]),
    ],
)
def test_filters(policies, filters, expected):
    assert sorted(ids(search.search(policies, **filters))) == expected


def test_pages(policies):
    assert ids(search.page(policies, 1, 2)) == [2, 1]
    assert ids(search.page(policies, "2", "2")) == [4, 5]
    assert ids(search.page(policies, 9, 2)) == []
    assert ids(search.page(policies, "abc", "999")) == [2, 1, 4, 5, 3]
    assert ids(search.page(policies, 2, 2, block=1)) == [4, 5]
    assert search.page(policies).columns == search.BRIEF
    assert search.total(search.search(policies, authority="云州")).collect()[0].total == 4


def test_walk_from_page_to_page(policies):
    """Each page from the last row of the one before, through the undated ones to the end."""
    seen, last = [], search.page(policies, 1, 1).collect()
    while last:
        seen.append(last[0].id)
        day = last[0].publish_date
        last = search.page_after(policies, day.isoformat() if day else None, last[0].id, 1).collect()
    assert seen == [2, 1, 4, 5, 3]
    assert ids(search.page_after(policies, "", 5)) == [3]


def test_pages_at_every_depth(spark):
    rows = [(i, None if i % 11 == 0 else dt.date(2024, 1, 1 + i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, publish_date date")
    for c in search.BRIEF:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    order = [i for i, _ in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or dt.date.min).toordinal(), -r[0]))]
    kept = search.rank_directory(df, 16)
    for number in (1, 7, 37, 40, 41):
        want = order[10 * (number - 1) : 10 * number]
        assert ids(search.page(df, number, 10)) == ids(search.page(df, number, 10, directory=kept, block=16)) == want


def test_a_page_after_a_day_that_is_none(policies):
    assert ids(search.page_after(policies, "2025-02-30", 9)) == [r.id for r in search.newest_first(policies).collect() if r.publish_date is None or str(r.publish_date) < "2025-02-30"]


def test_lookups(policies):
    assert ids(search.by_id(policies, "2")) == [2]
    assert ids(search.by_id(policies, "x")) == []
    assert ids(search.by_url(policies, "https://y.example.cn/3.html")) == [3]
    assert [r[0] for r in search.authorities(policies).collect()] == ["云州医保中心", "云州药监分局", "云州采购中心"]


def test_viewer_search(policies):
    assert ids(search.viewer_search(policies, keyword="gsp")) == [4]
    assert ids(search.viewer_search(policies, authority="药监")) == []
    assert ids(search.viewer_search(policies, authority="云州药监分局", status="有效", date_from="2025-01-01")) == [2]
    blank = policies.withColumn("validity_status", F.lit(""))
    assert len(ids(search.viewer_search(blank, status="有效"))) == 5


def test_scenarios(spark, policies):
    assert scenarios.list_scenarios(scenarios.scenario_table(spark)).count() == 6
    assert ids(scenarios.scenario_policies(policies, "sc_vbp")) == [1]
    assert ids(scenarios.scenario_policies(policies, "sc_unknown")) == []
    tagged = {tuple(r) for r in scenarios.tag_scenarios(policies).select("id", "scenario").collect()}
    assert {(1, "sc_vbp"), (2, "sc_trace"), (4, "sc_gsp")} <= tagged
    assert not {i for i, _ in tagged} & {3, 5}


def test_statistics(spark, policies):
    assert tuple(stats.latest_stats(policies, TODAY).collect()[0]) == (5, 5)
    later = TODAY + dt.timedelta(days=7)
    assert tuple(stats.latest_stats(policies, later).collect()[0]) == (0, 5)
    assert stats.added_since(policies, 7, TODAY + dt.timedelta(days=8)).collect()[0].added == 0
    summary = stats.health_summary(policies, source_table(spark), F.lit("now")).collect()[0]
    assert (summary.policies, summary.sources_enabled) == (5, ["nhc", "nhsa", "nmpa"])


def test_audit(policies):
    twice = policies.unionByName(policies.limit(1)).withColumn("title", F.expr("if(id = 3, ' ', title)"))
    audit = stats.policy_audit(twice).collect()[0]
    assert (audit.total, audit.missing_required, audit.duplicate_urls, audit.malformed_dates) == (6, 2, 1, 0)
    assert stats.policy_audit(policies, approximate=True).collect()[0].duplicate_urls == 0


def test_audit_of_parts_equals_the_audit_of_all(spark, policies):
    """Parts that share URLs, a part without rows, a table without parts."""
    rows = spark.range(3000).selectExpr(
        "IF(id % 7 = 0, NULL, 't') AS title", "concat('https://a/', CAST(id % 2000 AS STRING)) AS source_url",
        "IF(id % 5 = 0, '2024-02-30', '2024-02-03') AS publish_date", "'A' AS issuing_authority", "IF(id % 3 = 0, '', 'c') AS content",
    )
    cuts = ["source_url < 'https://a/15'", "source_url >= 'https://a/15'", "false"]
    parts = [stats.audit_part(rows.where(c)) for c in cuts]
    whole = stats.audit_of_parts(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(stats.audit_part(rows.limit(0)))).first()
    exact = stats.policy_audit(rows).first().asDict()
    for name, value in exact.items():
        assert whole[name] == value or (name == "duplicate_urls" and abs(whole[name] - value) <= 60), name
    assert exact["duplicate_urls"] == 1000
    doubled = stats.audit_of_parts(parts[0].unionByName(parts[0])).first()
    assert abs(doubled.duplicate_urls / doubled.total - 0.5) < 0.25
    assert set(stats.audit_of_parts(parts[0].limit(0)).first().asDict().values()) == {0}


def test_status_follows_the_date(policies):
    early = enrichment.recompute_validity(policies, "2025-01-01").orderBy("id").collect()
    assert [r.validity_status for r in early] == ["未生效", "未生效", "有效", "有效", "有效"]


def test_filters_reach_the_scan(spark, policies, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    path = str(tmp_path / "p")
    policies.write.parquet(path)
    found = search.brief(search.search(spark.read.parquet(path), status="有效", date_from="2025-01-01", authority="局"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(validity_status,有效)" in plan and "GreaterThanOrEqual(publish_date,2025-01-01)" in plan
    schema = plan.split("ReadSchema: struct<")[1]
    assert "content:" not in schema
    # A page of any depth: counts from thin columns, then a few ranges of ids, which are broadcast.
    page = search.page(search.search(spark.read.parquet(path), status="有效"), 2, 20)._jdf.queryExecution().executedPlan().toString()
    scans = page.split("ReadSchema: struct<")[1:]
    assert len(scans) >= 2 and not any("content:" in s.split("\n")[0] for s in scans)
    assert "BroadcastHashJoin" in page and page.count("EqualTo(validity_status,有效)") == len(scans)
