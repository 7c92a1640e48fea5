"""Incremental ingest into policies, feed and log: micro-batches, replays, failures, two writers."""

import random
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from edictum.operators.feed import merge_feed, positioned_feed
from edictum.operators.upsert import assign_ids, run_log, upsert
from edictum.schemas import FEED, FEED_COLUMNS, POLICIES
from edictum.session import shared_dir
from edictum.sources import tables
from edictum.streaming import store as st

BATCH = "seq bigint, source_url string, title string, content string, doc_number string, publish_date date, issuing_authority string"
NOW = F.lit("2025-01-01 00:00:00")


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"


def batches(seed=1):
    rng, seq, out = random.Random(seed), 0, []
    for _ in range(3):
        rows = []
        for _ in range(60):
            seq += rng.choice([1, 1, 5])
            url = rng.choice([f"https://a/{rng.randrange(40)}", f" https://b/{rng.randrange(20)} ", None, ""])
            day = rng.choice([None, __import__("datetime").date(2025, 1, 1 + rng.randrange(4))])
            rows.append((seq, url, rng.choice([f"t{seq}"] * 5 + [None]), f"c{seq}" * rng.randrange(80), "n", day, "A"))
        out.append(rows)
    return out


def one_by_one(spark, parts):
    """What the batch operators make of the parts, one run after the other."""
    stored, feed, logs = tables.empty(spark, POLICIES), tables.empty(spark, FEED + ", pos bigint"), []
    for rows in parts:
        batch = spark.createDataFrame(rows, BATCH)
        logs += run_log(batch, stored, "t", NOW, NOW).drop("start_time", "end_time").collect()
        after = assign_ids(upsert(stored, batch, NOW), stored).collect()
        feed_after = positioned_feed(merge_feed(feed, batch, NOW)).collect()
        stored, feed = spark.createDataFrame(after, POLICIES), spark.createDataFrame(feed_after, FEED + ", pos bigint")
    return stored, feed, logs


def policies(df):
    return sorted((r.source_url, r.id, r.title, r.content, r.doc_number, r.publish_date, r.issuing_authority, r.created_at) for r in df.collect())


def published(df):
    return [tuple(r[c] for c in FEED_COLUMNS) for r in df.orderBy("pos").collect()]


def check(store, stored, feed, logs):
    assert policies(store.rows("policies")) == policies(stored)
    # Records of one date keep the order they came in, run after run.
    assert published(st.published_feed(store)) == published(feed)
    got = store.rows("log").orderBy("id").drop("start_time", "end_time").collect()
    assert [r.id for r in got] == list(range(1, len(logs) + 1))
    assert [tuple(r)[1:] for r in got] == [tuple(r) for r in logs]


def test_three_micro_batches_one_replayed(spark, root):
    parts, source = batches(), f"{root}/in"
    store = st.Store(spark, f"{root}/store")
    for rows in parts:
        spark.createDataFrame(rows, BATCH).write.mode("append").parquet(source)
        stream = spark.readStream.schema(BATCH).parquet(source)
        st.start_runs(stream, store, f"{root}/state", "t", NOW).awaitTermination()
    want = one_by_one(spark, parts)
    check(store, *want)
    for again in (0, 1, 2):
        assert not st.ingest_batch(store, spark.createDataFrame(parts[again], BATCH), again, "t", NOW)
    check(store, *want)
    store.compact()
    assert len(store.commits()) == 1 and store.committed(2) and not store.committed(3)
    check(store, *want)
    more = batches(2)[0]
    assert st.ingest_batch(store, spark.createDataFrame(more, BATCH), 3, "t", NOW)
    check(store, *one_by_one(spark, [*parts, more]))


def test_a_batch_that_fails_before_its_commit_leaves_nothing(spark, root, monkeypatch):
    parts, store = batches(3), st.Store(spark, root)
    assert store.rows("policies").collect() == [] and not store.committed(0)
    st.ingest_batch(store, spark.createDataFrame(parts[0], BATCH), 0, "t", NOW)

    def broken(self, commit):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(st.Store, "commit", broken)
        with pytest.raises(RuntimeError):
            st.ingest_batch(store, spark.createDataFrame(parts[1], BATCH), 1, "t", NOW)
    check(store, *one_by_one(spark, parts[:1]))
    st.ingest_batch(store, spark.createDataFrame(parts[1], BATCH), 1, "t", NOW)
    check(store, *one_by_one(spark, parts[:2]))


def test_one_of_two_writers_commits(spark, root):
    rows = batches(4)[0]
    first, second = (st.Store(spark, root) for _ in range(2))
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda s: st.ingest_batch(s, spark.createDataFrame(rows, BATCH), 0, "t", NOW), (first, second)))
    assert sorted(done) == [False, True]
    check(first, *one_by_one(spark, [rows]))
    assert tables.commit_file(spark, f"{root}/x/a", "1") and not tables.commit_file(spark, f"{root}/x/a", "2")
    assert spark.read.text(f"{root}/x").collect()[0][0] == "1"


def test_runs_that_log_at_the_same_time_get_ids_of_their_own(spark, root):
    log = run_log(spark.createDataFrame(batches()[0], BATCH), tables.empty(spark, POLICIES), "t", NOW, NOW)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: tables.append_log(log, f"{root}/logs"), range(4)))
    assert sorted(r.id for r in tables.read_table(spark, f"{root}/logs").collect()) == [1, 2, 3, 4]
