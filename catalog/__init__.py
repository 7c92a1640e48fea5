"""Registered queries, each over the whole given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views import AS_OF, TABLES, cte
from edictum.session import configure
from edictum.sources.tables import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables and the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def pages(self) -> DataFrame:
        return spread(self.table("pages"))

    def sql(self, sql: str, parse: bool = False) -> DataFrame:
        """A query over tables and derived views, both by name; ``parse`` says pages are parsed."""
        for name in TABLES:
            if name in sql:
                rows = self.table(name)
                (spread(rows) if parse else rows).createOrReplaceTempView(name)
        return self.spark.sql(sql)

    def view(self, name: str, parse: bool = False) -> DataFrame:
        return self.sql(cte(f"SELECT * FROM {name}"), parse=parse or name.endswith("_pages"))


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables`; ``sql`` may use the derived views by name."""

    def register(fn: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = cte(sql)
        return fn

    return register


from catalog import documents, jobs, lists, merge, policies, registry, requests, streams, text  # noqa: E402,F401
