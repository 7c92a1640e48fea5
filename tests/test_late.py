"""Micro-batches sorted into new, repeated, late and undated rows."""

import random
import uuid

import pytest

from edictum.session import shared_dir
from edictum.streaming import late

SCHEMA = "seq bigint, source_url string, day date, at string, first string, known string"
DELAY = 10


@pytest.fixture
def root(spark):
    return f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"


def some_rows(spark, rows):
    import datetime as dt

    days = [(s, u, None if d is None else dt.date(2025, 1, 1) + dt.timedelta(days=d), "x", "y", "z") for s, u, d in rows]
    return spark.createDataFrame(days, SCHEMA)


def by_hand(parts):
    """Rows one after the other, against a set of remembered URLs and the watermark of the batches before."""
    newest, seen, out = None, {}, {}
    for batch, rows in enumerate(parts):
        mark = None if newest is None else newest - DELAY
        alive = {u: until for u, until in seen.items() if mark is None or until > mark}
        added = {}
        for seq, url, day in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0])):
            if day is None:
                what = "undated"
            elif mark is not None and day < mark:
                what = "late"
            elif url is None:
                what = "new"
            elif url in alive or url in added:
                what = "repeated"
            else:
                what, added[url] = "new", day + DELAY
            out[seq] = (what, batch)
        seen = alive | added
        newest = max([d for _, _, d in rows if d is not None] + ([newest] if newest is not None else []), default=None)
    return out


def found(spark, root, *outcomes):
    return {r.seq: (r.outcome, r.batch) for r in late.read_rows(spark, root, *outcomes).collect()}


def test_every_row_comes_out_once(spark, root):
    rng, parts, seq = random.Random(3), [], 0
    for start in (0, 4, 30, 25):
        rows = []
        for _ in range(80):
            seq += 1
            url = "hot" if rng.random() < 0.3 else rng.choice([f"u{rng.randrange(30)}", None, ""])
            rows.append((seq, url, None if rng.random() < 0.1 else start + rng.randrange(-8, 9)))
        parts.append(rows)
    for n, rows in enumerate(parts):
        assert late.ingest_rows(some_rows(spark, rows), n, root, "day", DELAY)
    expected = by_hand(parts)
    assert found(spark, root) == expected and {w for w, _ in expected.values()} == set(late.OUTCOMES)
    assert found(spark, root, "late") == {s: o for s, o in expected.items() if o[0] == "late"}
    kept = late.read_rows(spark, root).first()
    assert (kept["at"], kept["first"], kept["known"]) == ("x", "y", "z")


def test_replays_and_batches_that_failed(spark, root, monkeypatch):
    first, second = [(1, "a", 0), (2, "b", 40)], [(3, "a", 1), (4, "b", 41), (5, "c", 41)]
    late.ingest_rows(some_rows(spark, first), 0, root, "day", DELAY)
    with monkeypatch.context() as m:
        m.setattr(late, "commit_file", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            late.ingest_rows(some_rows(spark, second), 1, root, "day", DELAY)
    assert set(found(spark, root)) == {1, 2}
    assert late.ingest_rows(some_rows(spark, second), 1, root, "day", DELAY)
    assert not late.ingest_rows(some_rows(spark, second), 1, root, "day", DELAY)
    assert found(spark, root) == by_hand([first, second])


def test_empty_batches_and_taken_names(spark, root):
    late.ingest_rows(some_rows(spark, []), 0, root, "day", DELAY)
    late.ingest_rows(some_rows(spark, [(1, "a", None)]), 1, root, "day", DELAY)
    late.ingest_rows(some_rows(spark, [(2, "a", 3)]), 2, root, "day", DELAY)
    assert found(spark, root) == {1: ("undated", 1), 2: ("new", 2)}
    with pytest.raises(ValueError):
        late.ingest_rows(some_rows(spark, []).selectExpr("*", "1 AS outcome"), 3, root, "day", DELAY)
