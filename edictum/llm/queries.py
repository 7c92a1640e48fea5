"""Registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edictum.llm import alignment, chunks, decontaminate, divergence, language, licenses, lm, mixing, secrets, simhash, tokens, topk, toxicity
from edictum.llm.common import held, prepare, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
 source_size::DOUBLE * 2.0::DOUBLE AS bound FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(source_size) OVER (ORDER BY bound / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2.0::DOUBLE)
 / sum(w) OVER (ORDER BY bound / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
c AS (SELECT arg_min(level, bound / w) AS level FROM l WHERE bound >= level * w),
t AS (SELECT l.source, l.source_size, CASE WHEN c.level IS NULL THEN l.bound ELSE least(l.bound, c.level * l.w) END AS target FROM l, c),
r AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, coalesce(md5(CAST(doc_id AS VARCHAR)), ''), doc_id) AS rank FROM d),
p AS (SELECT r.doc_id, r.size, t.source_size, t.target, r.rank, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS ratio,
 CAST(concat('0x', substr(md5(concat('mix:', coalesce('=' || CAST(t.source AS VARCHAR), 'null'))), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u
 FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(least(floor(ratio * rank + u) - floor(ratio * (rank - 1) + u), 2) AS BIGINT) * size AS taken,
 CAST(least(floor(ratio * rank + u) - floor(ratio * (rank - 1) + u), 2) AS INTEGER) AS copies FROM p
"""


@query("op10_mixing", MIX_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systematic sampling of all documents to source targets."""
    return mixing.mix_report(read(spark, sf_dir, "documents"))


@query("op5_token_shards")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shards of all documents, written and read back."""
    shards = stage(tokens.encode_shards(read(spark, sf_dir, "documents")), "shards", compression="none")
    return tokens.token_report(shards)


@query("op7_licenses")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


@query("op1_toxicity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from four fifths of them."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held("doc_id", 5, 0))
    labels = read(spark, sf_dir, "labels").where(~held("doc_id", 5, 0))
    model = toxicity.learn(docs.where("NOT held_out"), labels)
    return toxicity.score_documents(docs, model)


@query("op2_language")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held("doc_id", 4, 2))
    return language.predict_languages(docs, language.learn(docs.where("NOT held_out")))


@query("op3_simhash")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by SimHash."""
    return simhash.report(read(spark, sf_dir, "documents"))


@query("op4_repeated_passages")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that another document has too."""
    return chunks.repeated_passages(read(spark, sf_dir, "documents"))


@query("op6_decontamination")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold copies of test items."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


TOPK_SQL = """
WITH ok AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS (SELECT r, vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS v FROM ok),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
"""


@query("op8_top_k", TOPK_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every fiftieth vector among all."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op9_lm_score")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of all documents under a model of six sevenths of them."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held("doc_id", 7, 2))
    return lm.score_documents(docs)


AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM v GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN v ON w.lang = v.lang AND w.term = v.term GROUP BY w.lang, w.source, w.term),
g AS (SELECT x.lang, x.source, coalesce(sum(c.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN c ON x.lang = c.lang AND x.source = c.source GROUP BY x.lang, x.source),
p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v)::HUGEINT AS p,
 1 + (1000000000::HUGEINT * (v.n + 1)) // (l.total + l.v)::HUGEINT AS q
 FROM g JOIN v ON g.lang = v.lang JOIN l ON l.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
 LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op13_source_divergence", AUDIT_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, over all documents."""
    return divergence.audit_sources(read(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in all documents, and how their ids go together."""
    return alignment.alignment_report(read(spark, sf_dir, "documents"))


@query("op12_secrets")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: assignments, known shapes and random strings."""
    return secrets.secret_report(read(spark, sf_dir, "documents"))
