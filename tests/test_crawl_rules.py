"""Robots rules, request log, source health, registries."""

import datetime as dt
import json
import random
import time

from pyspark.sql import functions as F

from edictum.operators import registry, requests, robots
from edictum.schemas import REQUEST_LOG, ROBOTS
from edictum.sources import navigation, tables

BODY = "User-agent: *\nDisallow: /archive/tmp\nDisallow: /feeds\nAllow: /archive/rules\n"


def check(spark, body, paths, **options):
    hosts = spark.createDataFrame([("h.cn", body)], ROBOTS)
    urls = spark.createDataFrame([(i, f"https://h.cn{p}") for i, p in enumerate(paths)], "i int, url string")
    return [r.allowed for r in robots.check_urls(urls, hosts, **options).orderBy("i").collect()]


def test_rules_by_prefix(spark):
    paths = ["/archive/rules/7.html", "/feeds/all.xml", "/archive/tmp?x=1", "/home", ""]
    assert check(spark, BODY, paths) == [True, False, False, True, True]


def test_last_match_decides_by_default(spark):
    body = "User-agent: *\r\nDisallow: /a/b\r\nAllow: /a\r\n# note\r\n\r\nno colon\r\n"
    assert check(spark, body, ["/a/b/c"]) == [True]
    assert check(spark, body, ["/a/b/c"], mode="longest") == [False]
    assert check(spark, body, ["/a/b/c"], mode="any_disallow") == [False]


def test_sections(spark):
    body = "Disallow: /early\nUser-agent: other\nDisallow: /foreign\nUser-agent: Edictum\nDisallow: /own\nUser-agent: third\nDisallow: /third\nUser-agent: *\nDisallow: /all"
    paths = ["/early", "/foreign", "/own", "/third", "/all"]
    assert check(spark, body, paths) == [False, False, False, True, False]
    assert check(spark, body, paths, agent="nobody") == [False, False, False, False, False]
    assert check(spark, body, paths, mode="any_disallow") == [False] * 5


def test_empty_disallow_means_everything(spark):
    assert check(spark, "User-agent: *\nDisallow:", ["/x"]) == [False]
    assert check(spark, "User-agent: *\nDisallow:", ["/x"], mode="any_disallow") == [True]


def test_hosts_without_robots_allow_all(spark):
    hosts = spark.createDataFrame([("a.cn", "User-agent: *\nDisallow: /")], ROBOTS)
    urls = spark.createDataFrame([("https://a.cn/x",), ("https://b.cn/x",)], "url string")
    assert [r.url for r in robots.allowed_only(urls, hosts).collect()] == ["https://b.cn/x"]
    rules = robots.robots_rules(hosts).collect()
    assert [tuple(r) for r in rules] == [("a.cn", 0, "disallow", "/")]


def decide(rules, path, mode):
    """Brute force: every rule against the path."""
    hits = [(i, kind, prefix) for i, (kind, prefix) in enumerate(rules) if path.startswith(prefix)]
    if mode == "any_disallow":
        return not any(kind == "disallow" for _, kind, _ in hits)
    if mode == "longest":
        hits = sorted(hits, key=lambda h: (len(h[2]), h[1] == "allow"))
    return not hits or hits[-1][1] == "allow"


def test_many_rules_equal_brute_force(spark):
    """Files on both sides of the bound, a hot host, repeated URLs and prefixes, text beyond ASCII, clashing names."""
    rng = random.Random(5)

    def path(depth):
        return "".join("/" + rng.choice(["a", "b", "文", "d1", "é"]) for _ in range(depth))

    files = {}
    for host, n in (("hot.cn", 3000), ("edge.cn", robots.FEW_RULES), ("over.cn", robots.FEW_RULES + 1), ("few.cn", 3)):
        files[host] = [(rng.choice(["allow", "disallow"]), path(rng.randint(1, 7))) for _ in range(n)]
    files["hot.cn"][5] = ("disallow", "/")
    bodies = [(h, "User-agent: *\n" + "\n".join(f"{k.title()}: {p}" for k, p in rules)) for h, rules in files.items()]
    hosts = spark.createDataFrame([*bodies, ("null.cn", None)], ROBOTS)
    names = ["hot.cn"] * 4 + [*files, "none.cn", "null.cn"]
    asked = [(i, rng.choice(names), path(rng.randint(0, 9))) for i in range(600)]
    asked += [(600 + i, "hot.cn", "/a/文") for i in range(300)]
    rows = [(i, f"https://{h}{p}", "x", "y", "z") for i, h, p in asked] + [(900, None, "x", "y", "z")]
    urls = spark.createDataFrame(rows, "i int, url string, host string, key string, allow string")
    for mode in ("last", "longest", "any_disallow"):
        checked = robots.check_urls(urls, hosts, mode=mode)
        assert checked.columns == [*urls.columns, "allowed"]
        found = {r.i: r for r in checked.collect()}
        assert len(found) == len(rows) and (found[900].allowed, found[900].host, found[900].key) == (True, "x", "y")
        for i, host, p in asked:
            assert found[i].allowed == decide(files.get(host, []), p or "/", mode), (mode, host, p)


def test_long_files_are_read_in_linear_time(spark):
    """50,000 rules in 2,000 sections, every other one foreign; those before the first of ours count."""
    lines, kept = [], []
    for section in range(2000):
        lines.append("User-agent: " + ("other" if section % 2 == 0 else "edictum"))
        rules = [f"/s{section}/{i}" for i in range(25)]
        lines += [f"Disallow: {p}" for p in rules]
        kept += rules if section % 2 or section == 0 else []
    hosts = spark.createDataFrame([("h.cn", "\n".join(lines))], ROBOTS)
    start = time.monotonic()
    found = robots.robots_rules(hosts).orderBy("seq").collect()
    assert [r.prefix for r in found] == kept and time.monotonic() - start < 20
    allowed = robots.check_urls(spark.createDataFrame([("https://h.cn/s4/1",), ("https://h.cn/s5/24/x",)], "url string"), hosts)
    assert {r.url[-3:]: r.allowed for r in allowed.collect()} == {"4/1": True, "4/x": False}


# ---------------------------------------------------------------- request log


def log_rows(spark, rows):
    t0 = dt.datetime(2026, 8, 8)
    full = [(run, i, url, 1, status, 0.1, t0 + dt.timedelta(seconds=sec)) for i, (run, url, status, sec) in enumerate(rows)]
    return spark.createDataFrame(full, REQUEST_LOG)


def test_outcomes_and_blocks(spark):
    log = log_rows(spark, [("r", "u", 0, 0), ("r", "u", 200, 5), ("r", "v", 0, 10), ("s", "u", 403, 0), ("s", "w", 200, 5), ("s", "x", 403, 9)])
    got = {(r.run_id, r.url): (r.status, r.attempts, r.fetched) for r in requests.outcomes(log).collect()}
    assert got[("r", "u")] == (200, 2, True) and got[("r", "v")] == (0, 1, False) and got[("s", "u")] == (403, 1, False)
    assert {r.run_id for r in requests.without_blocked_runs(log, log).collect()} == {"r"}
    assert sorted(r.seq for r in requests.until_block(log).collect()) == [0, 1, 2, 3]
    assert requests.retained(log, "2027-02-04").count() == 6 and requests.retained(log, "2027-02-05").count() == 0


def test_one_run_with_most_requests_is_spread(spark):
    log = log_rows(spark, [("hot", f"u{i}", 403 if i == 700 else 200, i) for i in range(1000)] + [("r", "u", 200, 0)])
    assert requests.until_block(log).where("run_id = 'hot'").count() == 701
    assert requests.without_blocked_runs(log, log).count() == 1
    assert requests.until_block(log).columns == log.columns
    plan = requests.until_block(log)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_log_stored_by_day(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_requests(log_rows(spark, [("r", "u", 200, 0), ("r", "u", 200, 86400 * 3)]), path)
    kept = requests.retained(spark.read.parquet(path), "2026-08-12", days=2)
    assert kept.count() == 1
    assert "PartitionFilters: [isnotnull(day" in kept._jdf.queryExecution().executedPlan().toString()


def test_politeness_against_a_plain_walk(spark):
    rng = random.Random(4)
    rows = [("r", f"https://h{rng.choice([1, 1, 1, 2])}.cn/p", 200, rng.choice([rng.randint(0, 900), rng.randint(0, 90000) / 10])) for _ in range(400)]
    got = {r.host: (r.requests, r.too_close, round(r.least_gap, 6)) for r in requests.politeness(log_rows(spark, rows)).collect()}
    want = {}
    for host in {r[1][8:13] for r in rows}:
        at = sorted(r[3] for r in rows if r[1][8:13] == host)
        gaps = [round(b - a, 6) for a, b in zip(at, at[1:])]
        want[host] = (len(at), sum(g < 4 for g in gaps), min(gaps))
    assert got == want


def test_health(spark):
    sources = registry.source_table(spark)
    urls = {s["id"]: s["list_url"] for s in registry.NATIONAL_SOURCES}
    log = log_rows(spark, [("r", urls["nmpa"], 403, 0), ("r", urls["nmpa"], 200, 5), ("r", urls["nhsa"], 412, 0), ("r", urls["cde"], 500, 0)])
    got = {r.source: (r.ok, r.detail) for r in requests.source_health(sources, log).collect()}
    assert got == {"nmpa": (True, "HTTP 200"), "nhsa": (False, "HTTP 412（站点可达，但被反爬拦截）"), "nhc": (False, "无响应")}
    policies = spark.range(3)
    row = requests.health_report(sources, log, policies, F.lit("2026-08-08T00:00:00")).collect()[0]
    report = json.loads(row.report)
    assert row.ok is False and report["db"]["detail"] == "数据库正常，政策 3 条" and len(report["sources"]) == 3
    good = log_rows(spark, [("r", urls[s], 200, 0) for s in ("nmpa", "nhsa", "nhc")])
    assert requests.health_report(sources, good, policies, F.lit("x")).collect()[0].ok is True


# ---------------------------------------------------------------- registries

NAV = {
    "医保局": [
        {"name": "国家", "area": "国家", "portal_url": "http://a.cn/", "system_urls": []},
        {"name": "北京", "area": "北京市", "portal_url": "http://b.cn", "system_urls": []},
        {"name": "again", "area": "上海市", "portal_url": "http://a.cn", "system_urls": []},
        {"name": "国家二", "area": "国家", "portal_url": "http://c.cn//", "system_urls": []},
        {"name": "国家三", "area": "国家", "portal_url": "http://d.cn", "system_urls": []},
        {"name": "blank", "area": "", "portal_url": "", "system_urls": []},
    ],
    "药监局": [{"name": "湖南", "area": "湖南省", "portal_url": "http://a.cn/"}, {"name": "新", "area": "Xyz", "portal_url": "http://n.cn"}],
    "卫健委": [{"name": "无区", "portal_url": "http://e.cn"}],
    "其他": [{"name": "x", "area": "国家", "portal_url": "http://z.cn"}],
}


def test_regional_registry(spark, tmp_path):
    path = tmp_path / "nav.json"
    path.write_text("﻿" + json.dumps(NAV, ensure_ascii=False), encoding="utf-8")
    found = registry.regional_sources(navigation.read_navigation(spark, str(path)))
    rows = {r.id: r for r in found.collect()}
    assert sorted(rows) == sorted(["nhsa_cn", "nhsa_bj", "nhsa_cn_1", "nhsa_cn_2", "nmpa_hn", "nmpa_xy", "nhc_xx"])
    assert rows["nhsa_cn_1"].name == "国家二" and rows["nhsa_cn_1"].base == "http://c.cn/"
    assert rows["nhsa_bj"].parser == "nhsa" and rows["nhsa_bj"].area == "北京市" and not rows["nhsa_bj"].enabled
    out = str(tmp_path / "reg")
    navigation.write_registry(found, out)
    national = registry.source_table(spark).select("id", "name", "area", "base", "portal_url", "list_url", "parser", "keep_paths", "enabled")
    regional = navigation.read_registry(spark, out).unionByName(national.where("id = 'nhc'").withColumn("name", F.lit("改")))
    merged = {r.id: r for r in registry.merge_registries(national, regional).collect()}
    assert len(merged) == 11 and merged["nhc"].name == "改" and merged["nhsa_bj"].parser == "nhsa"
    assert registry.enabled_sources(registry.source_table(spark)).count() == 3
    assert len(registry.AREA_CODES) == 33


def test_sources_without_directories_keep_their_list_pages(spark):
    got = {r.id: r.keep_paths for r in registry.with_keep_paths(registry.source_table(spark)).collect()}
    assert got["cde"] == ["/"] and got["nhsa"] == ["/art/"]


def test_long_robots_files_are_read_in_chunks(spark):
    """Whatever the chunks, rules are those of the whole file, and no task reads a long file alone."""
    rng = random.Random(5)
    lines = ["User-agent: *", "User-agent: other", "user-agent: EDICTUM", "# c", "", "Crawl-delay: 1", "Disallow:", "Allow: /a", "Disallow: /a/b", "Allow"]
    bodies = [(f"h{i}", "\n".join(rng.choices(lines, k=rng.randint(1, 40)))) for i in range(60)]
    files = spark.createDataFrame(bodies, "host string, body string")
    want = {}
    for r in sorted(robots.robots_rules(files).collect(), key=lambda r: r.seq):
        want.setdefault(r.host, []).append((r.kind, r.prefix))
    for chunk in (1, 3, 100):
        got = {}
        for r in sorted(robots._rules_of_long(files, "edictum", "last", chunk).collect(), key=lambda r: r.seq):
            got.setdefault(r.host, []).append((r.kind, r.prefix))
        assert got == want and len(got) > 40
    body = "User-agent: other\nDisallow: /p/1\nUser-agent: *\n" + "\n".join(f"{'Dis' if i % 3 else ''}allow: /p/{i}" for i in range(9000))
    body += "\nUser-agent: other\nDisallow: /\nDisallow: /p/8"
    assert len(body) > robots.LONG_FILE
    asked = spark.createDataFrame([(f"https://{h}/p/{i}x",) for i in range(0, 9900, 7) for h in ("long", "none")], "url string")
    for mode in ("last", "longest", "any_disallow"):
        found = robots.check_urls(asked, spark.createDataFrame([("long", body), ("empty", None)], "host string, body string"), mode=mode)
        for r in found.collect():
            hits = [x for k in range(1, 5) for x in [int(r.url.split("/p/")[1][:-1][:k] or -1)] if 0 <= x < 9000 and r.url.split("/p/")[1][:-1].startswith(str(x))]
            hits = sorted(set(hits))
            decided = (hits[-1] % 3 == 0) if hits else True
            if mode == "any_disallow":
                decided = False  # Disallow: / of the foreign section counts
            assert r.allowed == (decided if "//long/" in r.url else True), (mode, r.url)


def test_list_pages_are_parsed_before_robots_are_asked(spark, monkeypatch):
    """Checks that read their rows more than once read staged items, not the list pages."""
    from edictum.plans import ingest

    asked = []
    monkeypatch.setattr(ingest, "allowed_only", lambda urls, rules, **o: asked.append(urls) or robots.allowed_only(urls, rules, **o))
    kinds = "page_id bigint, source string, url string, base string, html string"
    page = '<ul><li><a href="/xxgk/fgwj/gzwj/gzwjyp/%d.html">关于药品的公告</a><span>2024-05-01</span></li></ul>'
    at = "https://www.nmpa.gov.cn/xxgk/fgwj/gzwj/gzwjyp/"
    lists = spark.createDataFrame([(i, "nmpa", at, at, page % i) for i in range(3)], kinds)
    pages = spark.createDataFrame([(i, "nmpa", f"{at}{i}.html", "", "<h1>公告</h1><p>正文</p>") for i in range(3)], kinds)
    rules = spark.createDataFrame([("www.nmpa.gov.cn", f"User-agent: *\nDisallow: /xxgk/fgwj/gzwj/gzwjyp/1")], ROBOTS)
    batch = ingest.crawl_batch(lists, pages, registry.source_table(spark), "2024-05-02", robots=rules)
    assert sorted(r.source_url for r in batch.collect()) == [f"{at}0.html", f"{at}2.html"]
    assert "staged-" in "".join(asked[0].inputFiles())
