"""Policies, feed and run log of an incremental ingest, as changes that a commit makes visible.

A micro-batch writes what it changes into folders of its own, in proportion to itself, and then one small
commit file that names them. What no commit names is not there, so a batch that failed half way leaves
nothing to see; a batch whose commit exists is done, so a replay changes nothing. The commit also
keeps the highest ids given so far: a new row gets its id without a look at the table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edictum import schemas
from edictum.operators.feed import feed_url, merge_feed, positioned_feed
from edictum.operators.numbering import number_rows
from edictum.operators.upsert import accepted, assign_ids, run_log, touched_rows, with_rows
from edictum.schemas import FEED_COLUMNS
from edictum.session import stage
from edictum.sources.tables import commit_file, empty, path_exists

TABLES = {
    "policies": f"{schemas.POLICIES}, batch bigint",
    "feed": f"{schemas.FEED}, ord bigint, batch bigint",
    "log": f"{schemas.CRAWLER_LOGS}, batch bigint",
}
KEYS = {"policies": "source_url", "feed": "url", "log": "id"}


@dataclass
class Commit:
    """What one batch left: a folder per table, and the highest ids and the range of feed places so far.

    ``whole`` says that the folders hold all rows, so earlier commits need not be read.
    """

    batch: int
    folders: dict[str, str]
    top_id: int = 0
    low_ord: int = 1
    top_ord: int = 0
    top_log: int = 0
    whole: bool = False


@dataclass
class Store:
    spark: SparkSession
    path: str
    schemas: dict[str, str] = field(default_factory=lambda: dict(TABLES))

    def commits(self) -> list[Commit]:
        """Commits in order, from the last one that holds everything; one small file each."""
        path = f"{self.path}/commits"
        if not path_exists(self.spark, path):
            return []
        found = sorted((Commit(**json.loads(r.value)) for r in self.spark.read.text(path).collect()), key=lambda c: (c.batch, c.whole))
        whole = max((i for i, c in enumerate(found) if c.whole), default=0)
        return found[whole:]

    def committed(self, batch_id: int) -> bool:
        """Whether a batch is done; those a compaction took in are."""
        commits = self.commits()
        return bool(commits) and batch_id <= commits[-1].batch

    def changes(self, table: str) -> DataFrame:
        """All committed changes of a table that count, with ``batch``."""
        folders = [c.folders[table] for c in self.commits()]
        if not folders:
            return empty(self.spark, self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*[f"{self.path}/{f}" for f in folders])

    def rows(self, table: str) -> DataFrame:
        """The last change of each key.

        Only keys and batches are brought together; those that a later batch replaced, few next to the
        table, are then left out of the rows by their keys.
        """
        key, changes = KEYS[table], self.changes(table)
        last = changes.groupBy(F.col(key).alias("_key")).agg(F.max("batch").alias("_last"), F.count(F.lit(1)).alias("_n"))
        replaced = last.where("_n > 1").drop("_n")
        same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("batch") < F.col("_last"))
        return changes.join(replaced, same, "left_anti").drop("batch")

    def of_keys(self, table: str, keys: DataFrame) -> DataFrame:
        """The current rows of some keys (``_key``), by a lookup in the changes."""
        key = KEYS[table]
        own = self.changes(table).join(keys, F.col(key) == F.col("_key"), "left_semi")
        last = own.groupBy(F.col(key).alias("_of")).agg(F.max("batch").alias("_last"))
        return own.join(last, (F.col(key) == F.col("_of")) & (F.col("batch") == F.col("_last")), "left_semi").drop("batch")

    def write(self, batch_id: int, tables: dict[str, DataFrame]) -> dict[str, str]:
        """Write the changes of a batch into new folders; nothing reads them before they are committed."""
        folders = {name: f"{name}/batch={batch_id}-{uuid.uuid4().hex}" for name in tables}
        for name, rows in tables.items():
            kinds = {f.name: f.dataType for f in self.spark.createDataFrame([], self.schemas[name]).schema}
            rows = rows.withColumn("batch", F.lit(batch_id))
            rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]).write.parquet(f"{self.path}/{folders[name]}")
        return folders

    def commit(self, commit: Commit) -> bool:
        """Make a batch visible in one step; False if another writer has committed it already."""
        name = f"{commit.batch:012d}{'-whole' if commit.whole else ''}.json"
        return commit_file(self.spark, f"{self.path}/commits/{name}", json.dumps(asdict(commit)))

    def compact(self) -> None:
        """Write the current rows of all tables as one commit, so that the folders before it are not read any more."""
        commits = self.commits()
        if commits and not commits[-1].whole:
            last = commits[-1]
            folders = self.write(last.batch, {name: self.rows(name) for name in KEYS})
            self.commit(Commit(last.batch, folders, last.top_id, last.low_ord, last.top_ord, last.top_log, whole=True))


def ingest_batch(store: Store, batch: DataFrame, batch_id: int, task_name: str, now: Column, update_cols: tuple[str, ...] | None = None) -> bool:
    """Merge the policy rows of a micro-batch into all three tables; False if it was committed before.

    The rules are those of the batch merge: later rows win, ``id`` and ``created_at`` stay, ids follow the
    first place in the batch, the feed keeps id and place of a URL, the log gets one row. Stored rows
    are read for the URLs of the batch alone.
    """
    if store.committed(batch_id):
        return False
    commits = store.commits()
    last = commits[-1] if commits else Commit(-1, {})
    rows = with_rows(batch)
    urls = stage(accepted(rows).select(F.col("source_url").alias("_key")).distinct())
    stored = stage(store.of_keys("policies", urls))
    touched = stage(touched_rows(stored, rows, now, update_cols=update_cols))
    log = run_log(rows, stored, task_name, now, now).withColumn("id", F.lit(last.top_log + 1))
    feed, low, top = feed_changes(store, rows, now, last)
    policies = assign_ids(touched, stored, top=F.lit(last.top_id))
    folders = store.write(batch_id, {"policies": policies, "feed": feed, "log": log})
    return store.commit(Commit(batch_id, folders, last.top_id + touched.where("is_new").count(), low, top, last.top_log + 1))


def feed_changes(store: Store, batch: DataFrame, now: Column, last: Commit) -> tuple[DataFrame, int, int]:
    """The feed records a batch touches, with ``ord``, and the lowest and highest ``ord`` after it.

    Among equal dates the published order is that of the run before, with new records at the end. A record
    that keeps its date so keeps its place; one that comes from a newer date goes before all others of its
    date, one from an older date behind them: all that changes is the ``ord`` of records the batch touches.
    """
    links = stage(batch.select(feed_url().alias("_key")).distinct())
    old = stage(store.of_keys("feed", links))
    merged = merge_feed(old.withColumnRenamed("ord", "pos"), batch, now)
    day = lambda c: F.coalesce(c, F.lit(""))
    before = old.select(F.col("url").alias("_url"), day(F.col("publish_date")).alias("_day"))
    way = F.when(F.col("is_added"), F.lit(2)).when(day(F.col("publish_date")) == F.col("_day"), F.lit(0))
    way = way.when(day(F.col("publish_date")) < F.col("_day"), F.lit(-1)).otherwise(F.lit(1))
    placed = merged.join(before, F.col("url") == F.col("_url"), "left").withColumn("_way", way)
    placed = number_rows(placed, "ord", groups=["_way"], descending=["_day"], out="_place")
    sizes = {r["_way"]: r["n"] for r in placed.groupBy("_way").agg(F.count(F.lit(1)).alias("n")).collect()}
    front, back, added = (sizes.get(w, 0) for w in (-1, 1, 2))
    start = F.when(F.col("_way") == -1, F.lit(last.low_ord - front - 1)).when(F.col("_way") == 1, F.lit(last.top_ord)).otherwise(F.lit(last.top_ord + back))
    ord_ = F.when(F.col("_way") == 0, F.col("ord")).otherwise(start + F.col("_place"))
    return placed.withColumn("ord", ord_).select(*FEED_COLUMNS, "ord"), last.low_ord - front, last.top_ord + back + added


def start_runs(stream: DataFrame, store: Store, checkpoint: str, task_name: str, now: Column | None = None) -> StreamingQuery:
    """Ingest a stream of policy rows with ``seq`` into the store, a run per micro-batch; ends with the input."""
    at = F.current_timestamp() if now is None else now
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: ingest_batch(store, batch, batch_id, task_name, at))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def published_feed(store: Store) -> DataFrame:
    """The feed as it is published, with ``pos``."""
    return positioned_feed(store.rows("feed"))
