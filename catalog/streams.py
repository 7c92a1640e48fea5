"""Streaming forms of the ingest, run over the given tables until they are used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import AS_OF, Tables, query
from catalog.documents import FIELDS
from catalog.jobs import SCRUBBED
from catalog.merge import LATEST, now, scratch, text
from catalog.views import cte
from edictum.operators.registry import source_table
from edictum.streaming import ingest, late
from edictum.streaming.store import Store, ingest_batch, published_feed, start_runs


def stream(t: Tables, name: str) -> DataFrame:
    """A given table as a stream of files."""
    return t.spark.readStream.schema(t.table(name).schema).parquet(f"{t.dir}/{name}*.parquet")


def incoming(t: Tables) -> DataFrame:
    """The rows of v_incoming as a stream."""
    first = stream(t, "documents").selectExpr(
        "doc_id AS seq",
        "concat('https://www.', source, '.example.org/art/', CAST(doc_id AS STRING), '.html') AS source_url",
        "CASE WHEN doc_id % 21 = 0 THEN NULL ELSE concat('新 ', CAST(doc_id AS STRING)) END AS title",
        "text AS content",
        "'n' AS doc_number",
        "doc_id % 9 = 0 AS again",
    )
    again = "transform(IF(again, array(0, 1), array(0)), k -> k)"
    return first.withColumn("k", F.explode(F.expr(again))).selectExpr(
        "seq + k * 1000000000 AS seq",
        "source_url",
        "IF(k = 1, concat('再 ', CAST(seq AS STRING)), title) AS title",
        "IF(k = 1, 'v2', content) AS content",
        "IF(k = 1, 'm', doc_number) AS doc_number",
    )


@query("stream_ingest", f"WITH {LATEST} SELECT source_url, title, content, doc_number, first_seq FROM latest")
def _(t: Tables):
    path = scratch(t, "changes")
    ingest.start_ingest(incoming(t), path, scratch(t, "ingest")).awaitTermination()
    rows = ingest.current_rows(ingest.read_changes(t.spark, path))
    return rows.select("source_url", "title", "content", "doc_number", "first_seq")


# ---------------------------------------------------------------- runs into policies, feed and log

RUN_OF = "CAST(seq % 1000000000 % 3 AS INT)"
#: Rows of v_incoming with all the feed needs, in three runs; the run's rows come after those of the run before.
RUNS = f"""SELECT seq + {RUN_OF} * 10000000000 AS seq, source_url, title, content, doc_number, DATE '2024-02-01' + CAST(seq % 20 AS INT) AS publish_date,
 'site ' AS issuing_authority, {RUN_OF} AS run FROM v_incoming
 UNION ALL SELECT seq + 30000000000, source_url, concat('later ', title), 'v3', 'k', DATE '2024-02-01' + CAST(seq % 13 AS INT), 'site', 2 FROM v_incoming WHERE seq % 1000000000 % 6 = 1"""
RAN = f"""WITH runs AS ({RUNS}), good AS (SELECT * FROM runs WHERE title IS NOT NULL),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq DESC) AS n, min(seq) OVER (PARTITION BY source_url) AS first_seq FROM good) x WHERE n = 1)"""


def three_runs(t: Tables) -> Store:
    """The incoming rows as three micro-batches of one stream; the second is handed in once more at the end."""
    source, state = scratch(t, "runs-in"), scratch(t, "runs-state")
    store = Store(t.spark, scratch(t, "store"))
    rows = t.sql(cte(RUNS))
    for run in range(3):
        part = rows.where(F.col("run") == run).drop("run")
        part.write.mode("append").parquet(source)
        arriving = t.spark.readStream.schema(part.schema).parquet(source)
        start_runs(arriving, store, state, "stream", now()).awaitTermination()
    ingest_batch(store, rows.where("run = 1").drop("run"), 1, "stream", now())
    return store


@query(
    "stream_policies",
    f"""{RAN} SELECT CAST(row_number() OVER (ORDER BY first_seq) AS BIGINT) AS id, source_url, title, doc_number, CAST(publish_date AS STRING) AS publish_date,
    issuing_authority, md5(content) AS content, '2025-01-01 00:00:00' AS created_at, '2025-01-01 00:00:00' AS updated_at FROM last""",
)
def _(t: Tables):
    """The policy table after three streamed runs, one of them replayed."""
    rows = three_runs(t).rows("policies")
    return rows.select("id", "source_url", "title", "doc_number", *text("publish_date"), "issuing_authority", F.md5("content").alias("content"), *text("created_at", "updated_at"))


@query(
    "stream_feed",
    f"""{RAN}, sent AS (SELECT *, row_number() OVER (PARTITION BY source_url, run ORDER BY seq DESC) AS n FROM runs), ends AS (SELECT * FROM sent WHERE n = 1),
    firsts AS (SELECT source_url, min(seq) AS first_seq FROM runs GROUP BY 1), days AS (SELECT f.source_url, f.first_seq,
     max(CASE WHEN run = 0 THEN publish_date END) AS d0, max(CASE WHEN run = 1 THEN publish_date END) AS d1, max(CASE WHEN run = 2 THEN publish_date END) AS d2
     FROM firsts f JOIN ends e ON f.source_url = e.source_url GROUP BY 1, 2),
    kept AS (SELECT source_url, first_seq, coalesce(d2, d1, d0) AS day2, coalesce(d1, d0) AS day1, d0 AS day0 FROM days),
    newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY run DESC, n) AS m FROM ends) x WHERE m = 1)
    SELECT concat('p_', substr(sha256(k.source_url), 1, 12)) AS id, trim(coalesce(r.title, '')) AS title, k.source_url AS url, CAST(r.publish_date AS STRING) AS publish_date,
     substr(r.content, 1, 200) AS content_preview, 'site' AS source_site, '2025-01-01 00:00:00' AS created_at,
     row_number() OVER (ORDER BY day2 DESC, day1 DESC NULLS LAST, day0 DESC NULLS LAST, first_seq) - 1 AS pos
    FROM kept k JOIN newest r ON k.source_url = r.source_url""",
)
def _(t: Tables):
    """The published feed after three streamed runs, one of them replayed."""
    return published_feed(three_runs(t))


@query(
    "stream_log",
    f"""{RAN}, firsts AS (SELECT source_url, min(run) AS run FROM good GROUP BY 1),
    counts AS (SELECT run, count(*) AS total_fetched, count(*) FILTER (WHERE title IS NULL) AS error_count,
     substr(string_agg(concat(source_url, ': NOT NULL constraint failed: policies.title'), chr(10) ORDER BY seq) FILTER (WHERE title IS NULL), 1, 4000) AS error_details FROM runs GROUP BY 1)
    SELECT CAST(c.run + 1 AS BIGINT) AS id, 'stream' AS task_name, total_fetched, (SELECT count(*) FROM firsts f WHERE f.run = c.run) AS new_added, error_count,
     coalesce(error_details, '') AS error_details, CASE WHEN error_count = 0 THEN 'SUCCESS' WHEN (SELECT count(*) FROM firsts f WHERE f.run = c.run) > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS status FROM counts c""",
)
def _(t: Tables):
    """The run log after three streamed runs, one of them replayed: a row for each run."""
    return three_runs(t).rows("log").drop("start_time", "end_time").withColumn("error_details", F.coalesce("error_details", F.lit("")))


@query(
    "stream_documents",
    f"""WITH {FIELDS} SELECT url AS source_url, title, doc_number, CASE WHEN issuing_authority = '' THEN '国家药品监督管理局' ELSE issuing_authority END AS issuing_authority,
    publish_date, CASE WHEN CAST(publish_date AS DATE) > DATE '{AS_OF}' THEN '未生效' ELSE '有效' END AS validity_status, md5({SCRUBBED.replace("r.content", "content")}) AS content FROM records""",
)
def _(t: Tables):
    """Document pages as a stream, parsed, prepared and kept as changes."""
    stream(t, "documents").createOrReplaceTempView("documents")
    pages = t.spark.sql(cte("SELECT * FROM v_document_pages"))
    t.spark.catalog.dropTempView("documents")
    path = scratch(t, "documents")
    rows = ingest.document_rows(pages, source_table(t.spark), AS_OF)
    ingest.start_ingest(rows, path, scratch(t, "documents-state")).awaitTermination()
    return ingest.current_rows(ingest.read_changes(t.spark, path)).select(
        "source_url", "title", "doc_number", "issuing_authority", "publish_date", "validity_status", F.md5("content").alias("content")
    )


@query("stream_distinct_urls", "SELECT DISTINCT url AS source_url FROM v_request_log")
def _(t: Tables):
    """The log spans 30 days; the watermark allows all of it."""
    rows = stream(t, "events").selectExpr(
        "concat('https://h', CAST(user_id % 20 AS STRING), '.example.org/p/', CAST(event_id % 3 AS STRING)) AS source_url",
        "CAST(ts AS TIMESTAMP) AS ts",
    )
    found = ingest.distinct_urls(rows, "ts", "60 days").select("source_url")
    return ingest.run_to_files(found, scratch(t, "urls"), scratch(t, "urls-state"))


@query(
    "stream_added_per_day",
    """SELECT CAST(CAST(ts AS DATE) AS STRING) AS day, count(*) AS added FROM events
    WHERE CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1""",
)
def _(t: Tables):
    """Days the watermark has closed."""
    rows = stream(t, "events").select(F.col("ts").cast("timestamp").alias("created_at"))
    days = ingest.run_to_files(ingest.added_per_day(rows), scratch(t, "days"), scratch(t, "days-state"))
    return days.select(F.col("day").cast("string").alias("day"), "added")


@query(
    "stream_recent_distinct",
    "SELECT DISTINCT source_url, date FROM (SELECT concat('u', CAST(doc_id AS STRING)) AS source_url, CASE WHEN doc_id % 4 = 0 THEN '' ELSE '2024-05-06' END AS date FROM documents) x",
)
def _(t: Tables):
    """Undated rows pass beside the watermark; dated ones are made distinct behind it."""
    rows = stream(t, "documents").selectExpr(
        "concat('u', CAST(doc_id AS STRING)) AS source_url", "CASE WHEN doc_id % 4 = 0 THEN '' ELSE '2024-05-06' END AS date"
    )
    found = ingest.recent_distinct(rows, 30)
    return ingest.run_to_files(found, scratch(t, "recent"), scratch(t, "recent-state"))


LATE = """SELECT concat('u', CAST(doc_id AS STRING)) AS source_url, CAST(doc_id % 3 AS INT) AS part,
 CASE WHEN doc_id % 3 = 0 THEN CAST(DATE '2024-01-01' + CAST(doc_id % 10 AS INT) AS STRING) WHEN doc_id % 3 = 1 THEN CAST(DATE '2024-03-01' + CAST(doc_id % 10 AS INT) AS STRING)
  WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN '2024-01-20' ELSE '2024-02-28' END AS date FROM documents"""


@query("stream_late_rows", f"SELECT source_url, date FROM ({LATE}) x WHERE part <> 2 OR date <> '2024-01-20'")
def _(t: Tables):
    """Three micro-batches over the same state: in the third, rows behind the watermark of the first two are dropped."""
    source, out, state = (scratch(t, n) for n in ("late-in", "late-out", "late-state"))
    rows = t.sql(LATE)
    for part in range(3):
        rows.where(F.col("part") == part).select("source_url", "date").write.mode("append").parquet(source)
        arriving = t.spark.readStream.schema("source_url string, date string").parquet(source)
        found = ingest.run_to_files(ingest.recent_distinct(arriving, 30), out, state)
    return found


# Three micro-batches: rows of URLs seen before, rows behind the watermark, rows without a day.
SORTED_IN = """SELECT doc_id AS seq, concat('u', CAST(doc_id % 40 AS STRING)) AS source_url, CAST(doc_id % 3 AS INT) AS part,
 CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN DATE '2024-01-01' + CAST(doc_id % 10 AS INT) WHEN doc_id % 3 = 1 THEN DATE '2024-03-01' + CAST(doc_id % 10 AS INT)
  WHEN doc_id % 4 = 1 THEN DATE '2024-01-20' ELSE DATE '2024-02-28' END AS day FROM documents"""


def first_rows(part: int) -> str:
    """The rows of a micro-batch by outcome, given those of the micro-batches before."""
    before = f"(SELECT max(day) - 30 FROM e WHERE part < {part})"
    seen = " UNION ALL ".join(f"SELECT source_url, day + 30 AS expires FROM o{p} WHERE outcome = 'new'" for p in range(part))
    known = f"source_url IN (SELECT source_url FROM ({seen}) s WHERE expires > {before})" if part else "false"
    is_late = f"day < {before}" if part else "false"
    return f"""o{part} AS (SELECT seq, source_url, day, part, CASE WHEN day IS NULL THEN 'undated' WHEN is_late THEN 'late' WHEN known OR n > 1 THEN 'repeated' ELSE 'new' END AS outcome
     FROM (SELECT *, row_number() OVER (PARTITION BY source_url, day IS NULL OR is_late ORDER BY day, seq) AS n
      FROM (SELECT *, coalesce({is_late}, false) AS is_late, {known} AS known FROM e WHERE part = {part}) x) y)"""


@query(
    "stream_rows_sorted_out",
    f"""WITH e AS ({SORTED_IN}), {", ".join(first_rows(p) for p in range(3))}
    SELECT seq, source_url, CAST(day AS STRING) AS day, outcome, CAST(part AS BIGINT) AS batch FROM (SELECT * FROM o0 UNION ALL SELECT * FROM o1 UNION ALL SELECT * FROM o2) x""",
)
def _(t: Tables):
    """Every row that came in, by what became of it; the second micro-batch is handed in once more at the end."""
    source, out, state = (scratch(t, n) for n in ("sorted-in", "sorted-out", "sorted-state"))
    rows = t.sql(SORTED_IN)
    for part in range(3):
        own = rows.where(F.col("part") == part).drop("part")
        own.write.mode("append").parquet(source)
        arriving = t.spark.readStream.schema(own.schema).parquet(source)
        late.start_rows(arriving, out, state, "day", 30).awaitTermination()
    late.ingest_rows(rows.where("part = 1").drop("part"), 1, out, "day", 30)
    found = late.read_rows(t.spark, out)
    return found.select("seq", "source_url", *text("day"), "outcome", F.col("batch").cast("bigint").alias("batch"))
