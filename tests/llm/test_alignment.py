import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from edictum.llm import alignment
from edictum.llm.common import byte_letters, prepare

SCHEMA = "doc_id bigint, text string, row int, pair bigint, links string"
ODD = ["", " a", "a ", "x  y", "\tx\ny é ü", "▁a b", "日本 語 a", "<|endoftext|> <s> x", "a\x85 b", "a 　b", "a\0b", " ", "\n", "don't 'll 12 345", "nbsp\xa0here you", "ﬁ ① é é", "​zero width", "İstanbul straße", "🙂 👍🏽 ok"]


@pytest.fixture(scope="module")
def coders():
    return alignment.Encoders(*alignment.default_tokenizers())


def fixture(n, seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "tokenization", "naïve", "über", "foo,", "(bar)", "x1y2", "don't", "1999", "été", "ét", "a-b", "日本語", "..."]
    words += ["".join(rng.choices("abcdeftn", k=rng.randint(2, 9))) for _ in range(300)]
    gap = lambda: rng.choice([" "] * 12 + ["  ", "\n", " \n", "\t"])
    return ["".join(rng.choice(words) + gap() for _ in range(rng.randint(0, 60))) for _ in range(n)]


def whole_ids(coders, text):
    """Ids of a text by one call each, and the bytes of each token; none where these are not the text."""
    if not text:
        return [], []
    sides = coders.a.encode(" " + text, add_special_tokens=False).ids, coders.b.encode(text)
    for ids, table in zip(sides, (coders.a_bytes, coders.b_bytes)):
        if b"".join(table[i] for i in ids) != b" " + text.encode():
            return [], []
    return sides


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i])))
        at = out[-1][1]
    return out


def test_ids_by_stretches_are_those_of_whole_texts(coders, monkeypatch):
    texts = ODD + fixture(200)
    for most, part in ((400_000, 1 << 19), (50, 40)):
        monkeypatch.setattr(alignment, "KNOWN_CHUNKS", most)
        monkeypatch.setattr(alignment, "PART", part)
        fresh = alignment.Encoders(*alignment.default_tokenizers())
        for text in texts:
            parts = list(fresh.parts(text))
            got = [np.frombuffer(b"".join(p[k] for p in parts), np.uint32).tolist() for k in (0, 1)]
            assert got == [list(x) for x in whole_ids(coders, text)], text
    assert whole_ids(coders, "▁a b") == ([], []) and whole_ids(coders, "<|endoftext|> <s> x")[0]


def test_bytes_of_tokens(coders):
    assert len(byte_letters()) == 256 and sorted(byte_letters().values()) == list(range(256))
    assert len(coders.a_bytes) == 50257 and len(coders.b_bytes) == 32000
    assert {b for x in coders.a_bytes[:256] for b in x} == set(range(256))


def brute(coders, texts):
    """All pairs of tokens of a document compared, counts over all documents."""
    rows, pair_counts = [], Counter()
    for text in texts:
        a, b = whole_ids(coders, text)
        sa, sb = spans(a, coders.a_bytes), spans(b, coders.b_bytes)
        over = [(i, j, x[1] == y[1]) for i, x in enumerate(sa) for j, y in enumerate(sb) if x[0] < y[1] and y[0] < x[1]]
        links = [(a[i], b[j]) for i, j, e in over if e]
        pair_counts.update(links)
        cuts = sorted({x[1] for x in sa} & {y[1] for y in sb})
        groups, at = [], 0
        for cut in cuts:
            inside = lambda ids, s: ",".join(str(i) for i, x in zip(ids, s) if at <= x[0] < cut)  # noqa: B023, E731
            groups.append(f"{inside(a, sa)}|{inside(b, sb)}")
            at = cut
        rows.append((a, b, over, links, groups))
    top = defaultdict(int)
    for (_, j), n in pair_counts.items():
        top[j] = max(top[j], n)
    report = []
    for a, b, _, links, groups in rows:
        best, total = sum(pair_counts[x] == top[x[1]] for x in links), sum(pair_counts[x] for x in links)
        report.append((len(a), len(b), len(groups), len(links), best, total, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return rows, report


@pytest.mark.parametrize("broadcast, most", [(100_000, 1 << 20), (20, 60), (0, 7)])
def test_report_and_alignment_against_all_pairs(spark, coders, broadcast, most):
    prepare(spark)
    texts = ODD + [None] + fixture(120)
    rows = [(i, t, 1, 2, "x") for i, t in enumerate(texts)]
    rows += [(None, texts[-1], None, None, None), (3, texts[-2], 1, 1, "y"), (3, texts[-2], 1, 1, "y")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found, report = brute(coders, [r[1] for r in rows])
    got = alignment.alignment_report(docs, slice_tokens=most, most_broadcast=broadcast).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *x) for r, x in zip(rows, report)), key=key)
    whole = alignment.align(docs, slice_tokens=most).collect()
    mine = [(r.doc_id, r.a_ids, r.b_ids, [tuple(o) for o in r.overlaps]) for r in whole]
    assert sorted(mine, key=key) == sorted(((r[0], list(x[0]), list(x[1]), x[2]) for r, x in zip(rows, found)), key=key)
    for r in whole:
        text = defaultdict(lambda: ([], []))
        for k, (ids, groups) in enumerate(((r.a_ids, r.a_group), (r.b_ids, r.b_group))):
            for i, g in zip(ids, groups):
                text[g][k].append(str(i))
        digest = hashlib.sha256(";".join(f"{','.join(text[g][0])}|{','.join(text[g][1])}" for g in sorted(text)).encode()).hexdigest()
        assert digest in {x[-1] for x in report} or not r.a_ids


def test_empty_table_and_text_without_tokens(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, None, 1, 1, ""), (2, "", 1, 1, ""), (3, "▁", 1, 1, "")], SCHEMA)
    assert sorted(map(tuple, alignment.alignment_report(docs).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    assert alignment.alignment_report(docs.limit(0)).collect() == [] and alignment.align(docs.limit(0)).collect() == []
    broken = docs.selectExpr("doc_id", "cast(X'41FF42' as string) AS text")
    assert {tuple(r)[1:] for r in alignment.alignment_report(broken).collect()} == {(0, 0, 0, 0, 0, 0, "")}
