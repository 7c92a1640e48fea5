"""Source registries, with rows derived from the customer and document tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Tables, query
from catalog.merge import scratch
from edictum.operators import registry
from edictum.sources import navigation

CODES = " ".join(f"WHEN '{area}' THEN '{code}'" for area, code in registry.AREA_CODES.items())
CODE = f"CASE area {CODES} ELSE CASE WHEN area = '' THEN 'xx' ELSE lower(substr(area, 1, 2)) END END"
REGIONAL = f"""firsts AS (SELECT *, row_number() OVER (PARTITION BY category, portal ORDER BY pos) AS n FROM
 (SELECT category, pos, name, area, rtrim(portal_url, '/') AS portal FROM v_navigation WHERE category <> '其他' AND portal_url <> '') x),
coded AS (SELECT concat(CASE category WHEN '医保局' THEN 'nhsa' WHEN '药监局' THEN 'nmpa' ELSE 'nhc' END, '_', {CODE}) AS sid, * FROM firsts WHERE n = 1),
regional AS (SELECT concat(sid, CASE WHEN k > 1 THEN concat('_', CAST(k - 1 AS STRING)) ELSE '' END) AS id, name, area, concat(portal, '/') AS base, split_part(sid, '_', 1) AS parser
 FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY pos) AS k FROM coded) y)"""


@query("area_codes", f"SELECT pos, {CODE} AS code FROM v_navigation")
def _(t: Tables):
    return t.view("v_navigation").select("pos", registry.area_code(F.col("area")).alias("code"))


@query("regional_sources", f"WITH {REGIONAL} SELECT id, name, area, base, parser, false AS enabled FROM regional")
def _(t: Tables):
    found = registry.regional_sources(t.view("v_navigation"))
    return found.select("id", "name", "area", "base", "parser", "enabled")


@query("navigation_files", "SELECT category, name, area, portal_url FROM v_navigation")
def _(t: Tables):
    """Navigation files of up to a thousand entries, each with a byte-order mark, written and read back."""
    path = scratch(t, "navigation")
    entry = F.struct("pos", "name", "area", "portal_url")
    part = F.concat_ws("-", F.hex(F.encode("category", "UTF-8")), F.floor(F.col("pos") / 1000).cast("string"))
    files = t.view("v_navigation").groupBy("category", part.alias("part")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    whole = F.concat(F.lit("\ufeff"), F.to_json(F.create_map("category", "entries")))
    files.select("part", whole.alias("value")).write.partitionBy("part").text(path)
    return navigation.read_navigation(t.spark, path).select("category", "name", "area", "portal_url")


@query(
    "registry_merge",
    f"""WITH {REGIONAL}, national AS (SELECT id, concat('national ', id) AS name FROM regional WHERE length(name) % 2 = 0 OR substr(id, 1, 3) = 'nhc' UNION ALL SELECT DISTINCT source, source FROM documents)
    SELECT id, name, 1 AS side FROM regional UNION ALL SELECT id, name, 0 FROM national WHERE id NOT IN (SELECT id FROM regional)""",
)
def _(t: Tables):
    """A regional row replaces the national row of the same id."""
    regional = registry.regional_sources(t.view("v_navigation")).select("id", "name", F.lit(1).alias("side"))
    overlap = regional.where("length(name) % 2 = 0 OR substr(id, 1, 3) = 'nhc'").select("id", F.concat(F.lit("national "), "id").alias("name"))
    own = t.sql("SELECT DISTINCT source AS id, source AS name FROM documents")
    return registry.merge_registries(overlap.unionByName(own).withColumn("side", F.lit(0)), regional)


@query("enabled_sources", "SELECT id FROM v_sources WHERE enabled")
def _(t: Tables):
    return registry.enabled_sources(t.view("v_sources")).select("id")


@query("registry_files", f"WITH {REGIONAL} SELECT id, name, base, parser, 0 AS paths FROM regional")
def _(t: Tables):
    """The registry written as JSON and read back."""
    path = scratch(t, "registry")
    navigation.write_registry(registry.regional_sources(t.view("v_navigation")), path)
    return navigation.read_registry(t.spark, path).select("id", "name", "base", "parser", F.size("keep_paths").alias("paths"))
