import random

import numpy as np
import pytest

from edictum.llm import decontaminate as dc
from edictum.llm.common import prepare, words_of

SCHEMA = "doc_id bigint, text string, item_id string, score string"


def words(n, seed, size=3000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def brute_cell(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = dc.MATCH if x == y else dc.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] - dc.GAP, table[i][j - 1] - dc.GAP)
            best = max(best, table[i][j])
    return best


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(1)
    for _ in range(150):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        assert dc.best_cell(a, b)[0] == brute_cell(a.tolist(), b.tolist())


def edited(item, seed, share=0.15):
    rng, out = random.Random(seed), []
    for w in item:
        x = rng.random()
        if x < share / 2:
            out.append("changed")
        elif x < share * 0.75:
            continue
        elif x < share:
            out += [w, "added"]
        else:
            out.append(w)
    return out


ITEMS = [(i, " ".join(words(30 + i, 1000 + i))) for i in range(12)]


def rows():
    out = [(i, " ".join(words(200, i)), "x", "y") for i in range(40)]
    for k in range(12):
        item = ITEMS[k][1].split()
        out.append((100 + k, " ".join([*words(60, 70 + k), *item, *words(50, 90 + k)]).upper(), None, None))
        out.append((200 + k, ", ".join([*words(60, 170 + k), *edited(item, k), *words(50, 190 + k)]), None, None))
    hot = [(300 + i, " ".join([*words(30, 400 + i), *ITEMS[0][1].split()]), None, None) for i in range(60)]
    odd = [(500, None, None, None), (501, "", None, None), (None, ITEMS[2][1], None, None), (502, " ".join([*words(20_000, 5), ITEMS[3][1]]), None, None)]
    return [*out, *hot, *odd, out[41]]


def benchmark(spark):
    items = [*ITEMS, (90, None), (91, ""), (92, "two words"), (None, " ".join(words(25, 2000))), ITEMS[1]]
    return spark.createDataFrame(items, "item_id bigint, text string")


def brute(rows, items, least):
    found = set()
    for doc_id, text, *_ in rows:
        body = words_of((text or "").encode())
        for item_id, item in items:
            a = words_of((item or "").encode())
            if len(a) >= 3 and any(body[i : i + 3] == a[j : j + 3] for i in range(len(body) - 2) for j in range(len(a) - 2)):
                share = brute_cell(a, body) / (dc.MATCH * len(a))
                if share >= least:
                    found.add((doc_id, item_id, round(share, 9)))
    return found


@pytest.mark.parametrize("block_words", [dc.BLOCK_WORDS, 100])
def test_leaks_against_full_alignment(spark, block_words):
    prepare(spark)
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = dc.contaminated(docs, benchmark(spark), block_words=block_words).collect()
    small = [r for r in rows() if r[0] != 502]
    assert {(r.doc_id, r.item_id, round(r.score, 9)) for r in got if r.doc_id != 502} == brute(small, ITEMS, dc.LEAST)
    found = {(r.doc_id, r.item_id) for r in got}
    assert found == {(100 + k, k) for k in range(12)} | {(200 + k, k) for k in range(12)} | {(300 + i, 0) for i in range(60)} | {(None, 2), (502, 3)}
    place = {r.doc_id: (r.first_word, r.last_word) for r in got}
    assert place[104] == (60, 60 + 33) and place[502] == (20_000, 20_032)

    kept = dc.without_leaks(docs, benchmark(spark), block_words=block_words)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(40), 500, 501]


def test_empty_tables(spark):
    prepare(spark)
    docs = spark.createDataFrame(rows()[:3], SCHEMA)
    none = benchmark(spark).limit(0)
    assert dc.contaminated(docs, none).collect() == [] and dc.without_leaks(docs, none).count() == 3
    assert dc.contaminated(docs.limit(0), benchmark(spark)).collect() == [] and dc.without_leaks(docs.limit(0), benchmark(spark)).count() == 0


def test_partial_copies_in_a_group_beside_a_full_copy(spark):
    """All n-grams of the half copies are frequent; those of the rest of the item are in one document."""
    prepare(spark)
    item = words(38, 5000)
    group = [(i, " ".join([*words(60, 6000 + i), *item[8:30], *words(40, 7000 + i)]), None, None) for i in range(100)]
    found = [*group, (900, " ".join(item), None, None), (901, " ".join(item[8:20]), None, None), (902, " ".join(item[9:12] * 30), None, None)]
    assert len(group) > dc.RARE_DOCS
    docs = spark.createDataFrame(found, SCHEMA)
    items = [(1, " ".join(item))]
    got = dc.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id, round(r.score, 9)) for r in got} == brute(found, items, dc.LEAST)
    assert {r.doc_id for r in got} == {*range(100), 900}


def test_no_alignment_matches_more_than_the_bound():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = rng.integers(1, 9, rng.integers(1, 20)), rng.integers(0, 9, rng.integers(1, 40))
        assert dc.best_cell(a, b)[0] <= dc.MATCH * dc.most_shared(a, b)
