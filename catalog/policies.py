"""Search, scenarios, statistics and audits over the policy table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import AS_OF, Tables, query
from catalog.merge import scratch
from edictum.functions.dates import clamp_int, validity_status
from edictum.functions.text import json_list, preview, scrub_pii
from edictum.functions.urls import attachment_name
from edictum.operators import enrichment, grams, scenarios, search, stats
from edictum.operators.numbering import number_rows
from edictum.operators.registry import source_table
from edictum.session import stage
from edictum.sources import tables

DAY = "CAST(publish_date AS STRING) AS publish_date"


def keyed(df):
    return df.select("id", F.col("publish_date").cast("string").alias("publish_date"), "source_url")


KEYED = f"SELECT id, {DAY}, source_url FROM v_policies"

# ---------------------------------------------------------------- search


@query("policies_scan", f"SELECT id, {DAY}, source_url, length(content) AS n FROM v_policies")
def _(t: Tables):
    return search.search(t.view("v_policies")).select(
        "id", F.col("publish_date").cast("string").alias("publish_date"), "source_url", F.length("content").alias("n")
    )


@query(
    "search_keyword",
    f"{KEYED} WHERE lower(title) LIKE '%the%' OR lower(content) LIKE '%the%' OR lower(doc_number) LIKE '%the%'",
)
def _(t: Tables):
    return keyed(search.search(t.view("v_policies"), keyword=" the "))


def stored(t: Tables) -> tuple[DataFrame, str]:
    """The policy table as files, and an index of its grams built in two steps."""
    path = scratch(t, "policies")
    rows = t.view("v_policies")
    tables.write_policies(rows.where("publish_date < DATE '2025-01-01'"), f"{path}/rows/a")
    table = t.spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{path}/rows")
    grams.update_index(table, f"{path}/index")
    tables.write_policies(rows.where("NOT coalesce(publish_date < DATE '2025-01-01', false)"), f"{path}/rows/b")
    table = t.spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{path}/rows")
    grams.update_index(table, f"{path}/index")
    return table, f"{path}/index"


WORDS = ("废止%the", "药品追溯码", "SRC1〔2021〕")
ANY_WORD = " OR ".join(f"{c} ILIKE '%{w}%'" for w in WORDS for c in ("title", "content", "doc_number"))


@query("search_keyword_indexed", f"{KEYED} WHERE {ANY_WORD}")
def _(t: Tables):
    """Three keywords, one with a wildcard, by the gram index of the stored table."""
    table, index = stored(t)
    found = [grams.search_stored(table, index, w) for w in WORDS]
    return keyed(found[0].unionByName(found[1]).unionByName(found[2])).distinct()


@query("policy_lookup_stored", f"{KEYED} WHERE source_url = 'https://www.src2.example.org/art/2.html' OR id = 7")
def _(t: Tables):
    """One URL and one id, looked up in the stored table by its bloom filters."""
    table, _index = stored(t)
    return keyed(search.by_url(table, "https://www.src2.example.org/art/2.html").unionByName(search.by_id(table, 7)))


@query("search_keyword_wildcard", f"{KEYED} WHERE title ILIKE '%t_e%' OR content ILIKE '%t_e%' OR doc_number ILIKE '%t_e%'")
def _(t: Tables):
    return keyed(search.search(t.view("v_policies"), keyword="T_e"))


@query("search_authority", f"{KEYED} WHERE issuing_authority ILIKE '%RC1%'")
def _(t: Tables):
    return keyed(search.search(t.view("v_policies"), authority="RC1"))


@query("search_tag", f"{KEYED} WHERE tags ILIKE '%E%'")
def _(t: Tables):
    return keyed(search.search(t.view("v_policies"), tag="E"))


@query("search_exact_tag", f"{KEYED} WHERE tags = '[\"de\"]'")
def _(t: Tables):
    policies = t.view("v_policies").withColumn("tags", F.from_json("tags", "array<string>"))
    return keyed(search.search(policies, exact_tag="de"))


@query("search_status", f"{KEYED} WHERE validity_status = '废止'")
def _(t: Tables):
    return keyed(search.search(t.view("v_policies"), status="废止"))


@query("search_date_range", f"{KEYED} WHERE publish_date BETWEEN DATE '2024-03-01' AND DATE '2024-07-31'")
def _(t: Tables):
    return keyed(search.search(t.view("v_policies"), date_from="2024-03-01", date_to="2024-07-31"))


@query(
    "search_undated_upper_bound",
    "SELECT id FROM v_policies WHERE id % 7 = 0 OR publish_date <= DATE '2024-07-31'",
)
def _(t: Tables):
    policies = t.view("v_policies").withColumn("publish_date", F.expr("if(id % 7 = 0, NULL, publish_date)"))
    return search.search(policies, date_to="2024-07-31").select("id")


@query(
    "search_all_filters",
    f"""{KEYED} WHERE content ILIKE '%of%' AND issuing_authority ILIKE '%src%' AND tags ILIKE '%en%'
    AND validity_status = '有效' AND publish_date >= DATE '2024-02-01' AND publish_date <= DATE '2024-12-31'""",
)
def _(t: Tables):
    return keyed(
        search.search(
            t.view("v_policies"), keyword="of", authority="src", tag="en", status="有效",
            date_from="2024-02-01", date_to="2024-12-31",
        )
    )


@query(
    "search_viewer",
    f"""{KEYED} WHERE contains(lower(concat(title, ' ', doc_number, ' ', content)), 'the') AND issuing_authority = 'src1'
    AND validity_status = '有效' AND publish_date >= DATE '2024-02-01' AND publish_date <= DATE '2025-06-30'""",
)
def _(t: Tables):
    found = search.viewer_search(
        t.view("v_policies"), keyword="The", authority="src1", status="有效", date_from="2024-02-01", date_to="2025-06-30"
    )
    return keyed(found)


PAGE = f"""SELECT id, title, doc_number, issuing_authority, {DAY}, validity_status, source_url, tags FROM v_policies
WHERE content ILIKE '%the%' OR title ILIKE '%the%' OR doc_number ILIKE '%the%'"""


def _page(t: Tables, **page):
    found = search.page(search.search(t.view("v_policies"), keyword="the"), **page)
    return found.withColumn("publish_date", F.col("publish_date").cast("string"))


@query("search_page", f"SELECT * FROM ({PAGE}) p ORDER BY publish_date DESC, id DESC LIMIT 20")
def _(t: Tables):
    return _page(t, page=1)


@query("search_page_clamped", f"SELECT * FROM ({PAGE}) p ORDER BY publish_date DESC, id DESC LIMIT 100 OFFSET 100")
def _(t: Tables):
    return _page(t, page="2", size="999")


@query("search_page_deep", f"SELECT * FROM ({PAGE}) p ORDER BY publish_date DESC, id DESC LIMIT 40 OFFSET 80")
def _(t: Tables):
    """A page from a directory kept with the table, in blocks of few ids."""
    found = search.search(t.view("v_policies"), keyword="the")
    directory = stage(search.rank_directory(found, 64))
    return _page(t, page=3, size=40, directory=directory, block=64)


@query(
    "search_page_after",
    f"""SELECT id, {DAY} FROM v_policies WHERE v_policies.publish_date < DATE '2025-03-01'
    OR (v_policies.publish_date = DATE '2025-03-01' AND id < 500) ORDER BY v_policies.publish_date DESC, id DESC LIMIT 20""",
)
def _(t: Tables):
    found = search.page_after(t.view("v_policies"), "2025-03-01", 500)
    return found.select("id", F.col("publish_date").cast("string").alias("publish_date"))


@query(
    "search_page_after_impossible_day",
    f"""SELECT id, {DAY} FROM v_policies WHERE CAST(v_policies.publish_date AS STRING) < '2025-02-30' OR (CAST(v_policies.publish_date AS STRING) = '2025-02-30' AND id < 3)
    ORDER BY v_policies.publish_date DESC, id DESC LIMIT 20""",
)
def _(t: Tables):
    found = search.page_after(t.view("v_policies"), "2025-02-30", 3)
    return found.select("id", F.col("publish_date").cast("string").alias("publish_date"))


@query("search_total", "SELECT count(*) AS total FROM v_policies WHERE content ILIKE '%the%' OR title ILIKE '%the%'")
def _(t: Tables):
    return search.total(search.search(t.view("v_policies"), keyword="the"))


@query("policies_brief", f"SELECT id, title, doc_number, issuing_authority, {DAY}, validity_status, source_url, tags FROM v_policies")
def _(t: Tables):
    return search.brief(t.view("v_policies")).withColumn("publish_date", F.col("publish_date").cast("string"))


@query("policies_newest_first", f"SELECT id, {DAY}, row_number() OVER (ORDER BY publish_date DESC, id DESC) AS place FROM v_policies")
def _(t: Tables):
    """Order of the whole table, shown as row numbers."""
    rows = t.view("v_policies").select("id", "publish_date", (-F.col("id")).alias("back"))
    places = number_rows(rows, "back", out="place", descending=["publish_date"], parts=8)
    return places.select("id", F.col("publish_date").cast("string").alias("publish_date"), "place")


@query("policy_by_id", f"{KEYED} WHERE id = 42")
def _(t: Tables):
    return keyed(search.by_id(t.view("v_policies"), "42"))


@query("policy_by_url", f"{KEYED} WHERE source_url = 'https://www.src7.example.org/art/27.html'")
def _(t: Tables):
    return keyed(search.by_url(t.view("v_policies"), "https://www.src7.example.org/art/27.html"))


@query("authorities", "SELECT DISTINCT issuing_authority FROM v_policies WHERE issuing_authority <> ''")
def _(t: Tables):
    return search.authorities(t.view("v_policies"))


# ---------------------------------------------------------------- scalar functions over policies


@query(
    "scrub_pii",
    """SELECT id, regexp_replace(regexp_replace(content, '(^|[^0-9])[0-9]{17}[0-9Xx]($|[^0-9])', '\\1[身份证号已脱敏]\\2', 'g'),
    '(^|[^0-9])1[3-9][0-9]{9}($|[^0-9])', '\\1[手机号已脱敏]\\2', 'g') AS content FROM v_policies""",
)
def _(t: Tables):
    return t.view("v_policies", parse=True).select("id", scrub_pii(F.col("content")).alias("content"))


@query(
    "validity_status",
    f"""SELECT id, CASE WHEN contains(title, '废止') OR contains(title, '失效') THEN '废止'
    WHEN publish_date > DATE '{AS_OF}' THEN '未生效' ELSE '有效' END AS validity_status FROM v_policies""",
)
def _(t: Tables):
    return t.view("v_policies").select(
        "id", validity_status(F.col("title"), F.col("publish_date"), AS_OF).alias("validity_status")
    )


@query(
    "recompute_validity",
    """SELECT CASE WHEN contains(title, '废止') OR contains(title, '失效') THEN '废止'
    WHEN publish_date > DATE '2025-06-30' THEN '未生效' ELSE '有效' END AS validity_status, count(*) AS n FROM v_policies GROUP BY 1""",
)
def _(t: Tables):
    fresh = enrichment.recompute_validity(t.view("v_policies"), "2025-06-30")
    return fresh.groupBy("validity_status").agg(F.count(F.lit(1)).alias("n"))


@query("content_preview", "SELECT id, substr(content, 1, 200) AS preview FROM v_policies")
def _(t: Tables):
    return t.view("v_policies").select("id", preview(F.col("content")).alias("preview"))


@query("tags_from_json", "SELECT id, CASE WHEN id % 3 = 0 THEN 0 ELSE 1 END AS n, CASE WHEN id % 3 = 0 THEN '' ELSE substr(tags, 3, 2) END AS tag FROM v_policies")
def _(t: Tables):
    """Lenient JSON: objects and broken text count as empty."""
    broken = F.expr("CASE id % 6 WHEN 0 THEN concat('{\"a\":', tags, '}') WHEN 3 THEN substr(tags, 1, 4) ELSE tags END")
    tags = json_list(broken, "string")
    return t.view("v_policies").select(
        "id", F.size(tags).alias("n"), F.coalesce(F.get(tags, F.lit(0)), F.lit("")).alias("tag")
    )


@query(
    "clamp_integer",
    """SELECT id, greatest(1, least(100, coalesce(TRY_CAST(CASE WHEN id % 5 = 0 THEN '' ELSE CAST(id - 50 AS STRING) END AS INT), 20))) AS size FROM v_policies""",
)
def _(t: Tables):
    text = F.expr("CASE WHEN id % 5 = 0 THEN 'x' ELSE CAST(id - 50 AS STRING) END")
    return t.view("v_policies").select("id", clamp_int(text, 20, 1, 100).alias("size"))


@query(
    "attachment_name",
    "SELECT id, CASE id % 3 WHEN 0 THEN concat('文 ', CAST(id AS STRING), '.pdf') WHEN 1 THEN 'file' ELSE concat(CAST(id AS STRING), '+1.doc') END AS name FROM v_policies",
)
def _(t: Tables):
    url = F.expr("""concat('https://x.org/a/', CASE id % 3 WHEN 0 THEN concat('%E6%96%87%20', CAST(id AS STRING), '.pdf')
        WHEN 1 THEN '' ELSE concat(CAST(id AS STRING), '+1.doc') END)""")
    return t.view("v_policies").select("id", attachment_name(url).alias("name"))


# ---------------------------------------------------------------- scenarios

HITS = " UNION ALL ".join(
    f"SELECT '{s['id']}' AS scenario, id FROM blobs WHERE "
    + " OR ".join(f"contains(blob, '{k.lower()}')" for k in s["keywords"])
    for s in scenarios.SCENARIOS
)
BLOBS = "WITH blobs AS (SELECT id, lower(concat(title, ' ', content, ' ', tags, ' ', doc_number)) AS blob FROM v_policies)"


@query("scenario_tags", f"{BLOBS} {HITS}")
def _(t: Tables):
    return scenarios.tag_scenarios(t.view("v_policies", parse=True)).select("scenario", "id")


@query("scenario_policies", f"{BLOBS} SELECT id FROM blobs WHERE contains(blob, '集采') OR contains(blob, '带量采购') OR contains(blob, '中选') OR contains(blob, '集中采购')")
def _(t: Tables):
    return scenarios.scenario_policies(t.view("v_policies"), "sc_vbp").select("id")


@query("search_impossible_date", "SELECT id FROM v_policies WHERE CAST(publish_date AS VARCHAR) >= '2025-02-30'")
def _(t: Tables):
    """A bound that is no day of the calendar is compared as text."""
    return search.search(t.view("v_policies"), date_from="2025-02-30").select("id")


@query("search_page_after_undated", "SELECT id FROM v_policies WHERE id % 7 = 0 AND id < 700 ORDER BY id DESC LIMIT 20")
def _(t: Tables):
    """The page after an undated row goes on among the undated ones; every seventh policy is one here."""
    undated = t.view("v_policies").withColumn("publish_date", F.expr("IF(id % 7 = 0, NULL, publish_date)"))
    return search.page_after(undated, None, 700).select("id")


@query("scenario_unknown", "SELECT s.scenario, count(p.id) AS policies FROM (SELECT DISTINCT concat('sc_', source) AS scenario FROM documents) s LEFT JOIN (SELECT id FROM v_policies WHERE false) p ON true GROUP BY s.scenario")
def _(t: Tables):
    """Scenarios named after the sources of the documents: none is listed, so none has policies."""
    tagged = scenarios.tag_scenarios(t.view("v_policies")).select("scenario", F.col("id").alias("tagged"))
    names = t.view("v_policies").select(F.concat(F.lit("sc_"), F.col("issuing_authority")).alias("scenario")).distinct()
    return names.join(tagged, "scenario", "left").groupBy("scenario").agg(F.count("tagged").alias("policies"))


@query("scenario_counts", f"{BLOBS}, hits AS ({HITS}) SELECT scenario, count(*) AS policies FROM hits GROUP BY scenario")
def _(t: Tables):
    """Scenario list with the number of policies in each."""
    names = scenarios.list_scenarios(scenarios.scenario_table(t.spark)).withColumnRenamed("id", "scenario")
    hits = scenarios.tag_scenarios(t.view("v_policies", parse=True)).groupBy("scenario").agg(F.count(F.lit(1)).alias("policies"))
    return hits.join(names, "scenario").select("scenario", "policies")


# ---------------------------------------------------------------- statistics and audits


@query("added_today", f"SELECT count(*) FILTER (WHERE CAST(created_at AS DATE) = DATE '{AS_OF}') AS added FROM v_policies")
def _(t: Tables):
    return stats.added_since(t.view("v_policies"), 0, AS_OF)


@query("added_since", f"SELECT count(*) FILTER (WHERE CAST(created_at AS DATE) >= DATE '{AS_OF}' - 7) AS added FROM v_policies")
def _(t: Tables):
    return stats.added_since(t.view("v_policies"), 7, AS_OF)


@query(
    "latest_stats",
    f"""SELECT count(*) FILTER (WHERE CAST(created_at AS DATE) = DATE '{AS_OF}') AS today,
    count(*) FILTER (WHERE CAST(created_at AS DATE) >= DATE '{AS_OF}' - 7) AS week FROM v_policies""",
)
def _(t: Tables):
    return stats.latest_stats(t.view("v_policies"), AS_OF)


@query("health_summary", "SELECT true AS ok, count(*) AS policies, 'nhc,nhsa,nmpa' AS sources_enabled FROM v_policies")
def _(t: Tables):
    summary = stats.health_summary(t.view("v_policies"), source_table(t.spark), F.current_timestamp())
    return summary.select("ok", "policies", F.array_join("sources_enabled", ",").alias("sources_enabled"))


AUDITED = """SELECT CASE WHEN id % 50 = 0 THEN ' ' ELSE title END AS title, CASE WHEN id % 40 = 0 THEN 'https://x/123456.html' ELSE source_url END AS source_url,
 CASE WHEN id % 30 = 0 THEN '2024-13-01' WHEN id % 31 = 0 THEN '2024.1.1' WHEN id % 32 = 0 THEN '' ELSE CAST(publish_date AS STRING) END AS publish_date,
 issuing_authority, CASE WHEN id % 20 = 0 THEN '' ELSE content END AS content, id % 8 AS links FROM v_policies"""


def audited(t: Tables) -> DataFrame:
    return t.view("v_policies").selectExpr(
        "CASE WHEN id % 50 = 0 THEN ' ' ELSE title END AS title",
        "CASE WHEN id % 40 = 0 THEN 'https://x/123456.html' ELSE source_url END AS source_url",
        """CASE WHEN id % 30 = 0 THEN '2024-13-01' WHEN id % 31 = 0 THEN '2024.1.1' WHEN id % 32 = 0 THEN ''
        ELSE CAST(publish_date AS STRING) END AS publish_date""",
        "issuing_authority",
        "CASE WHEN id % 20 = 0 THEN '' ELSE content END AS content",
        "array_repeat('l', CAST(id % 8 AS INT)) AS attachment_links",
    )


@query(
    "policy_audit",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE trim(title) = '' OR publish_date = '') AS missing_required,
    count(*) FILTER (WHERE publish_date IN ('2024-13-01', '2024.1.1')) AS malformed_dates, count(*) - count(DISTINCT source_url) AS duplicate_urls,
    count(*) FILTER (WHERE source_url LIKE '%/123456.html') AS placeholder_urls, count(*) FILTER (WHERE content <> '') AS with_content,
    count(*) FILTER (WHERE links > 0) AS with_attachments FROM ({AUDITED}) a""",
)
def _(t: Tables):
    return stats.policy_audit(audited(t))


@query(
    "policy_audit_of_parts",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE trim(title) = '' OR publish_date = '') AS missing_required,
    count(*) FILTER (WHERE publish_date IN ('2024-13-01', '2024.1.1')) AS malformed_dates, true AS duplicates_within_error,
    count(*) FILTER (WHERE source_url LIKE '%/123456.html') AS placeholder_urls, count(*) FILTER (WHERE content <> '') AS with_content,
    count(*) FILTER (WHERE links > 0) AS with_attachments FROM ({AUDITED}) a""",
)
def _(t: Tables):
    """The audit from what was stored with each of four parts: counts exact, URLs by merged sketches (error under 3 per cent of the URLs)."""
    rows, path = audited(t), scratch(t, "audit-parts")
    for part in range(4):
        stats.audit_part(rows.where(F.pmod(F.xxhash64("title", "source_url"), F.lit(4)) == part)).write.mode("append").parquet(path)
    found = stats.audit_of_parts(t.spark.read.parquet(path))
    urls = rows.agg(F.countDistinct("source_url")).scalar()
    exact = rows.agg(F.count("source_url") - F.countDistinct("source_url")).scalar()
    near = F.abs(F.col("duplicate_urls") - exact) <= urls * 0.03
    return found.withColumn("duplicates_within_error", near).drop("duplicate_urls")


@query("rows_per_authority", "SELECT issuing_authority, count(*) AS policies FROM v_policies GROUP BY 1")
def _(t: Tables):
    return stats.rows_per_authority(t.view("v_policies"))
