"""Robots rules, the request log and source health."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import AS_OF, Tables, query
from edictum.operators import requests, robots

# ---------------------------------------------------------------- robots

LINES = """raw AS (SELECT host, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS n FROM v_robots),
lines AS (SELECT host, n, lower(trim(split_part(line, ':', 1))) AS key, trim(substr(line, instr(line, ':') + 1)) AS value FROM raw WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#'))"""
RULES = f"""{LINES}, marked AS (SELECT *, CASE WHEN key = 'user-agent' THEN value = '*' END AS hit FROM lines),
state AS (SELECT *, coalesce(max(CAST(hit AS INT)) OVER w, 0) AS seen, last_value(hit IGNORE NULLS) OVER w AS latest FROM marked
 WINDOW w AS (PARTITION BY host ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rules AS (SELECT host, CAST(row_number() OVER (PARTITION BY host ORDER BY n) - 1 AS INT) AS seq, key AS kind, CASE WHEN value = '' THEN '/' ELSE value END AS prefix
 FROM state WHERE key IN ('allow', 'disallow') AND NOT (seen = 1 AND NOT latest))"""
URLS = "urls AS (SELECT DISTINCT url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM v_request_log)"


def urls(t: Tables):
    return t.view("v_request_log").select("url").distinct()


@query("robots_lines", f"WITH {LINES} SELECT host, CAST(row_number() OVER (PARTITION BY host ORDER BY n) - 1 AS INT) AS seq, key, value FROM lines")
def _(t: Tables):
    return robots.robots_lines(t.view("v_robots"))


@query("robots_rules", f"WITH {RULES} SELECT host, seq, kind, prefix FROM rules")
def _(t: Tables):
    return robots.robots_rules(t.view("v_robots"))


@query(
    "robots_check",
    f"""WITH {RULES}, {URLS}, last_hit AS (SELECT u.url, r.kind, row_number() OVER (PARTITION BY u.url ORDER BY r.seq DESC) AS k
     FROM urls u JOIN rules r ON u.host = r.host AND starts_with(u.path, r.prefix))
    SELECT u.url, coalesce(h.kind = 'allow', true) AS allowed FROM urls u LEFT JOIN last_hit h ON u.url = h.url AND h.k = 1""",
)
def _(t: Tables):
    return robots.check_urls(urls(t), t.view("v_robots"))


@query(
    "robots_check_longest",
    f"""WITH {RULES}, {URLS}, hits AS (SELECT u.url, r.kind, row_number() OVER (PARTITION BY u.url ORDER BY length(r.prefix) DESC, r.kind) AS k
     FROM urls u JOIN rules r ON u.host = r.host AND starts_with(u.path, r.prefix))
    SELECT u.url, coalesce(h.kind = 'allow', true) AS allowed FROM urls u LEFT JOIN hits h ON u.url = h.url AND h.k = 1""",
)
def _(t: Tables):
    return robots.check_urls(urls(t), t.view("v_robots"), mode="longest")


@query(
    "robots_check_any_disallow",
    f"""WITH {LINES}, {URLS} SELECT u.url, count(l.value) = 0 AS allowed FROM urls u
    LEFT JOIN lines l ON u.host = l.host AND l.key = 'disallow' AND l.value <> '' AND starts_with(u.path, l.value) GROUP BY u.url""",
)
def _(t: Tables):
    return robots.check_urls(urls(t), t.view("v_robots"), mode="any_disallow")


@query("robots_missing", "SELECT DISTINCT url, true AS allowed FROM v_request_log WHERE contains(url, 'h18.') OR contains(url, 'h19.')")
def _(t: Tables):
    """Hosts without a robots file allow everything."""
    rules = t.view("v_robots").select("host")
    checked = robots.check_urls(urls(t), t.view("v_robots"))
    host = F.regexp_extract("url", "^https://([^/]*)", 1)
    return checked.withColumn("host", host).join(rules, "host", "left_anti").select("url", "allowed")


@query(
    "robots_allowed_requests",
    f"""WITH {RULES}, {URLS}, last_hit AS (SELECT u.url, r.kind, row_number() OVER (PARTITION BY u.url ORDER BY r.seq DESC) AS k
     FROM urls u JOIN rules r ON u.host = r.host AND starts_with(u.path, r.prefix))
    SELECT seq, url FROM v_request_log WHERE url NOT IN (SELECT url FROM last_hit WHERE k = 1 AND kind = 'disallow')""",
)
def _(t: Tables):
    """Every request of the log meets its host's rules; nothing is made distinct first."""
    return robots.allowed_only(t.view("v_request_log").select("seq", "url"), t.view("v_robots"))


MANY = """asked AS (SELECT event_id AS seq, concat('h', CAST(user_id % 4 AS STRING), '.example.org') AS host, concat('/p/', CAST(event_id AS STRING)) AS path, event_type FROM events),
ruled AS (SELECT host, seq, CASE WHEN event_type = 'error' THEN 'disallow' ELSE 'allow' END AS kind,
 CASE WHEN event_type = 'error' THEN concat('/p/', CAST((seq - seq % 10) / 10 AS INT)) ELSE path END AS prefix FROM asked WHERE event_type IN ('error', 'signup'))"""


@query(
    "robots_check_many_rules",
    f"""WITH {MANY}, hits AS (SELECT a.seq, r.kind, row_number() OVER (PARTITION BY a.seq ORDER BY r.seq DESC) AS k
     FROM asked a JOIN ruled r ON a.host = r.host AND starts_with(a.path, r.prefix))
    SELECT a.seq, coalesce(h.kind = 'allow', true) AS allowed FROM asked a LEFT JOIN hits h ON a.seq = h.seq AND h.k = 1""",
)
def _(t: Tables):
    """Robots files that grow with the log: a rule for every event that failed or signed up."""
    asked = t.sql(f"WITH {MANY} SELECT seq, concat('https://', host, path) AS url FROM asked")
    lines = t.sql(f"WITH {MANY} SELECT host, struct(seq, concat(kind, ': ', prefix) AS line) AS line FROM ruled")
    listed = F.transform(F.sort_array(F.collect_list("line")), lambda r: r["line"])  # a host's group is its file
    files = lines.groupBy("host").agg(F.concat(F.lit("User-agent: *\n"), F.array_join(listed, "\n")).alias("body"))
    return robots.check_urls(asked, files).select("seq", "allowed")


# ---------------------------------------------------------------- the request log


@query(
    "request_outcomes",
    """SELECT run_id, url, status, attempts, status <> 0 AND status <> 403 AS fetched FROM (SELECT run_id, url, status,
    row_number() OVER (PARTITION BY run_id, url ORDER BY seq DESC) AS n, count(*) OVER (PARTITION BY run_id, url) AS attempts FROM v_request_log) x WHERE n = 1""",
)
def _(t: Tables):
    return requests.outcomes(t.view("v_request_log"))


@query("blocked_runs", "SELECT run_id, min(seq) AS blocked_at FROM v_request_log WHERE status = 403 GROUP BY run_id")
def _(t: Tables):
    return requests.blocked_runs(t.view("v_request_log"))


@query("without_blocked_runs", "SELECT run_id, seq FROM v_request_log WHERE run_id NOT IN (SELECT run_id FROM v_request_log WHERE status = 403)")
def _(t: Tables):
    log = t.view("v_request_log")
    return requests.without_blocked_runs(log, log).select("run_id", "seq")


@query(
    "requests_until_block",
    """SELECT run_id, seq FROM (SELECT run_id, seq, max(CASE WHEN status = 403 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS blocked FROM v_request_log) x WHERE coalesce(blocked, 0) = 0""",
)
def _(t: Tables):
    return requests.until_block(t.view("v_request_log")).select("run_id", "seq")


@query("retained_requests", "SELECT seq FROM v_request_log WHERE ts >= DATE '2024-07-10' - 180")
def _(t: Tables):
    return requests.retained(t.view("v_request_log"), "2024-07-10").select("seq")


GAPS = """SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, epoch_us(ts) AS us FROM v_request_log"""


@query(
    "politeness",
    f"""SELECT host, count(*) AS requests, count(*) FILTER (WHERE gap < 2000000000) AS too_close, min(gap) / 1000000.0 AS least_gap
    FROM (SELECT host, us - lag(us) OVER (PARTITION BY host ORDER BY us) AS gap FROM ({GAPS}) g) x GROUP BY host""",
)
def _(t: Tables):
    """Gaps of under 2000 seconds: the given log is sparse."""
    return requests.politeness(t.view("v_request_log"), min_gap=2000.0)


# ---------------------------------------------------------------- source health


@query(
    "status_classes",
    """SELECT seq, CASE WHEN status = 0 THEN 'no response' WHEN status < 400 THEN 'ok' WHEN status IN (403, 412) THEN 'blocked' ELSE 'fail' END AS class FROM v_request_log""",
)
def _(t: Tables):
    status = F.nullif("status", F.lit(0))
    return t.view("v_request_log").select("seq", requests.status_class(status).alias("class"))


HEALTH = """SELECT s.id AS source, s.list_url AS url, coalesce(p.status BETWEEN 1 AND 399, false) AS ok,
 CASE WHEN p.status IS NULL OR p.status = 0 THEN '无响应' WHEN p.status IN (403, 412) THEN concat('HTTP ', CAST(p.status AS STRING), '（站点可达，但被反爬拦截）')
 ELSE concat('HTTP ', CAST(p.status AS STRING)) END AS detail FROM v_sources s LEFT JOIN
 (SELECT url, status FROM (SELECT url, status, row_number() OVER (PARTITION BY url ORDER BY ts DESC, seq DESC) AS n FROM v_request_log) x WHERE n = 1) p
 ON s.list_url = p.url WHERE s.enabled"""


@query("source_health", HEALTH)
def _(t: Tables):
    return requests.source_health(t.view("v_sources"), t.view("v_request_log"))


ENTRIES = """string_agg(concat('{"source":"', source, '","url":"', url, '","ok":', CAST(ok AS STRING), ',"detail":"', detail, '"}'), ',' ORDER BY source)"""


@query(
    "health_report",
    f"""SELECT bool_and(ok) AS ok, concat('{{"ok":', CAST(bool_and(ok) AS STRING), ',"checked_at":"{AS_OF}","db":{{"ok":true,"detail":"数据库正常，政策 ',
    (SELECT CAST(count(*) AS STRING) FROM v_policies), ' 条"}},"sources":[', {ENTRIES}, ']}}') AS report FROM ({HEALTH}) h""",
)
def _(t: Tables):
    return requests.health_report(t.view("v_sources"), t.view("v_request_log"), t.view("v_policies"), F.lit(AS_OF))


@query(
    "health_report_no_store",
    f"""SELECT false AS ok, concat('{{"ok":false,"checked_at":"{AS_OF}","db":{{"ok":false,"detail":"数据库异常: no such table"}},"sources":[',
    {ENTRIES}, ']}}') AS report FROM ({HEALTH}) h""",
)
def _(t: Tables):
    """The store cannot be read; the sources are reported all the same."""
    return requests.health_report(t.view("v_sources"), t.view("v_request_log"), None, F.lit(AS_OF), "no such table")
