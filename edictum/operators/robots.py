"""Robots files to rules, and rules to decisions about URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edictum.functions.names import fresh
from edictum.functions.text import let, trim_u
from edictum.functions.urls import url_host, url_path
from edictum.operators.skew import lookup, thin_side
from edictum.session import stage

AGENT = "edictum"
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
FEW_RULES = 256  # files of more rules are looked up by prefix
LONG_FILE = 1 << 16  # bytes: longer files are read in chunks, by several tasks
CHUNK_LINES = 4096
MOST_BYTES = 8 << 20  # of the short files together, to be sent to every task


def _rule(kind: Column, prefix: Column) -> Column:
    return F.struct(kind.alias("kind"), prefix.alias("prefix"))


def _split(body: Column) -> Column:
    return F.split(body, _LINE_END, -1)


def _lines(body: Column) -> Column:
    """(key, value) of the lines that are neither blank nor a comment."""
    return _read(_split(body))


def _read(lines: Column) -> Column:
    lines = F.transform(lines, trim_u)
    kept = F.filter(lines, lambda line: (line != "") & ~F.startswith(line, F.lit("#")))
    return F.transform(
        kept,
        lambda line: F.struct(
            F.lower(trim_u(F.substring_index(line, ":", 1))).alias("key"),
            trim_u(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )


def rule_list(body: Column, agent: str = AGENT) -> Column:
    """Ordered rules of a robots file that apply to ``agent``.

    A rule is left out while the latest user-agent line is a foreign one that follows a matching
    one; rules before any matching line count. An empty value stands for ``/``. The lines between two
    user-agent lines count or not as a whole and are cut out at once, so a file takes time in
    proportion to its lines.
    """
    return _rules_in(_lines(body), agent, F.lit(False), F.lit(True))


def _is_ours(line: Column, agent: str) -> Column:
    return (line["value"] == "*") | (F.lower(line["value"]) == agent.lower())


def _rules_in(lines: Column, agent: str, seen: Column, counting: Column) -> Column:
    """Rules of a stretch of lines; ``seen``: a matching line came before it, ``counting``: rules count where it begins."""

    def rules_of(lines: Column) -> Column:
        agents = F.filter(
            F.transform(
                lines,
                lambda line, i: F.struct(
                    i.alias("at"), (line["key"] == "user-agent").alias("agent"), _is_ours(line, agent).alias("ours")
                ),
            ),
            lambda mark: mark["agent"],
        )
        return let(agents, lambda marks: sections(lines, marks))

    def sections(lines: Column, marks: Column) -> Column:
        size = F.size(lines)
        first = F.coalesce(F.get(F.filter(marks, lambda m: m["ours"]), F.lit(0))["at"], size)
        first = F.when(seen, F.lit(-1)).otherwise(first)
        top = F.slice(lines, F.lit(1), F.when(counting, F.coalesce(F.get(marks, F.lit(0))["at"], size)).otherwise(F.lit(0)))
        spans = F.transform(
            marks,
            lambda m, j: F.struct(
                (m["at"] + 2).alias("from"),
                (F.coalesce(F.get(marks, j + 1)["at"], size) - m["at"] - 1).alias("n"),
                (m["ours"] | (m["at"] < first)).alias("counts"),
            ),
        )
        parts = F.transform(F.filter(spans, lambda s: s["counts"]), lambda s: F.slice(lines, s["from"], s["n"]))
        return F.concat(top, F.flatten(parts))

    kept = F.filter(let(lines, rules_of), lambda line: line["key"].isin("allow", "disallow"))
    return F.transform(kept, lambda line: _rule(line["key"], F.coalesce(F.nullif(line["value"], F.lit("")), F.lit("/"))))


def _rules_of_long(files: DataFrame, agent: str, mode: str, chunk: int = CHUNK_LINES) -> DataFrame:
    """(host, seq, kind, prefix) of files (host, body) of any length; ``seq`` ascends within a file.

    A file is only cut into chunks of lines by one task. Chunks are dealt out and read on their own; what
    a chunk begins with follows from one thin row for each chunk before it.
    """
    starts = lambda lines: F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / chunk).cast("int"))
    cut = let(_split(F.col("body")), lambda lines: F.transform(starts(lines), lambda i: F.slice(lines, i * chunk + 1, F.lit(chunk))))
    chunks = files.select("host", F.posexplode(cut).alias("chunk", "raw")).repartition("host", "chunk")
    wanted = F.filter(_read(F.col("raw")), lambda line: line["key"].isin("user-agent", "allow", "disallow"))
    read = stage(chunks.select("host", "chunk", wanted.alias("lines")))
    seq = F.col("chunk").cast("bigint") * chunk + F.col("pos")
    if mode == "any_disallow":
        hits = F.filter("lines", lambda line: (line["key"] == "disallow") & (line["value"] != ""))
        found = read.select("host", "chunk", F.posexplode(F.transform(hits, lambda h: _rule(h["key"], h["value"]))).alias("pos", "rule"))
        return found.select("host", seq.alias("seq"), "rule.*")
    agents = F.transform(F.filter("lines", lambda line: line["key"] == "user-agent"), lambda line: _is_ours(line, agent))
    marks = read.select("host", "chunk", F.exists(agents, lambda a: a).alias("any"), F.try_element_at(agents, F.lit(-1)).alias("last"))
    so_far = Window.partitionBy("host").orderBy("chunk")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("met", F.max("any").over(so_far)).withColumn("after", F.when(F.col("last").isNotNull(), F.col("last") | ~F.col("met")))
    state = marks.select(
        "host",
        "chunk",
        F.coalesce(F.max("any").over(before), F.lit(False)).alias("seen"),
        F.coalesce(F.last("after", ignorenulls=True).over(before), F.lit(True)).alias("counting"),
    )
    rules = _rules_in(F.col("lines"), agent, F.col("seen"), F.col("counting"))
    same = ["host", "chunk"]
    found = read.join(thin_side(stage(state)), same).select(*same, F.posexplode(rules).alias("pos", "rule"))
    return found.select("host", seq.alias("seq"), "rule.*")


def disallowed_prefixes(body: Column) -> Column:
    """Every non-empty Disallow value, whatever section it is in."""
    hits = F.filter(_lines(body), lambda line: (line["key"] == "disallow") & (line["value"] != ""))
    return F.transform(hits, lambda line: line["value"])


def robots_lines(robots: DataFrame) -> DataFrame:
    """(host, seq, key, value) of every line that counts for anything."""
    return robots.select("host", F.posexplode(_lines(F.col("body"))).alias("seq", "line")).select(
        "host", "seq", "line.key", "line.value"
    )


def robots_rules(robots: DataFrame, agent: str = AGENT) -> DataFrame:
    """(host, seq, kind, prefix). ``robots`` has one row (host, body) per host."""
    return robots.select("host", F.posexplode(rule_list(F.col("body"), agent)).alias("seq", "rule")).select(
        "host", "seq", "rule.kind", "rule.prefix"
    )


def _decide(rules: Column, path: Column, mode: str) -> Column:
    hits = F.filter(rules, lambda r: F.startswith(path, r["prefix"]))
    if mode == "longest":
        ranked = F.transform(
            hits, lambda r: F.struct(F.length(r["prefix"]).alias("len"), (r["kind"] == "allow").alias("allow"))
        )
        return F.array_max(ranked)["allow"]
    return F.try_element_at(hits, F.lit(-1))["kind"] == "allow"


def _decide_by_prefix(paths: DataFrame, rules: DataFrame, mode: str) -> DataFrame:
    """(key, allow) of the paths (host, path) that some rule of (host, seq, kind, prefix) matches.

    A path is cut at the lengths its host's prefixes have, and the cuts are looked up by equality, so
    a path costs as many lookups as there are lengths, however many rules there are.
    """
    # What decides and how, as one number: it is added up in hash tables, and nothing is sorted.
    allow = (F.col("kind") == "allow").cast("bigint")
    weight = F.length("prefix") * 2 + allow if mode == "longest" else F.col("seq")
    found = (weight * 2 + allow).alias("found")
    table = stage(rules.select("host", "prefix", found).groupBy("host", "prefix").agg(F.max("found").alias("found")))
    lengths = stage(table.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths")))
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    # Staged, as the cuts are counted before they are looked up.
    paths = stage(paths.select("host", "path").distinct())
    cuts = paths.join(thin_side(lengths), "host").select("host", "path", F.explode(fitting).alias("n"))
    host = F.col("host")
    cuts = cuts.select(_pair(host, F.col("path")).alias("key"), _pair(host, F.substr("path", F.lit(1), F.col("n"))).alias("cut"))
    found = lookup(cuts, table.select(_pair(host, F.col("prefix")).alias("cut"), "found"), "cut", how="inner")
    return found.groupBy("key").agg((F.max("found") % 2 == 1).alias("allow"))


def _pair(host: Column, path: Column) -> Column:
    """One key of both; a host holds no blank."""
    return F.concat(host, F.lit(" "), path)


def check_urls(
    urls: DataFrame, robots: DataFrame, agent: str = AGENT, mode: str = "last", url: str = "url"
) -> DataFrame:
    """``urls`` with ``allowed``: the last matching rule of the host decides, none means yes.

    ``mode="longest"`` lets the longest prefix decide instead; ``mode="any_disallow"`` lets any
    Disallow line deny. A file of up to 256 rules travels with the URL as one array, so a URL meets
    its host's rules in one row. Rules of longer files stay a table of prefixes that the distinct
    paths are looked up in, and files of more than 64 KB are read by several tasks. Either way the URLs
    of one host are spread over several tasks; where all short files together are small, URLs stay where they are.
    """
    files = stage(robots.select("host", "body"))
    is_long = F.coalesce(F.octet_length("body") > LONG_FILE, F.lit(False))
    body = F.col("body")
    if mode == "any_disallow":
        compiled = F.transform(disallowed_prefixes(body), lambda p: _rule(F.lit("disallow"), p))
    else:
        compiled = rule_list(body, agent)
    every = stage(files.where(~is_long).select("host", compiled.alias("rules")))
    many = F.size("rules") > FEW_RULES
    host, rules, key, allow = fresh(urls, "host", "rules", "key", "allow")
    path = url_path(F.col(url), root=True)
    few = every.where(~many).withColumnsRenamed({"host": host, "rules": rules})
    size, n_long = files.agg(F.sum(F.when(~is_long, F.octet_length("body"))), F.count_if(is_long)).first()
    hosted = urls.withColumn(host, url_host(F.col(url)))
    checked = hosted.join(F.broadcast(few), host, "left") if (size or 0) <= MOST_BYTES else lookup(hosted, few, host)
    decided = _decide(F.col(rules), path, mode)
    long = every.where(many)
    if n_long or not long.isEmpty():
        table = long.select("host", F.posexplode("rules").alias("pos", "rule")).select("host", F.col("pos").cast("bigint").alias("seq"), "rule.*")
        hosts = long.select("host")
        if n_long:
            table = table.unionByName(_rules_of_long(files.where(is_long), agent, mode))
            hosts = hosts.union(files.where(is_long).select("host"))
        keyed = urls.select(url_host(F.col(url)).alias("host"), path.alias("path"))
        paths = keyed.join(thin_side(stage(hosts)), "host", "left_semi")
        found = _decide_by_prefix(paths, table, mode).withColumnsRenamed({"key": key, "allow": allow})
        checked = lookup(checked.withColumn(key, _pair(F.col(host), path)), found, key)
        decided = F.coalesce(decided, F.col(allow))
    return checked.select(*urls.columns, F.coalesce(decided, F.lit(True)).alias("allowed"))


def allowed_only(
    urls: DataFrame, robots: DataFrame, agent: str = AGENT, mode: str = "last", url: str = "url"
) -> DataFrame:
    return check_urls(urls, robots, agent, mode, url).where("allowed").drop("allowed")
