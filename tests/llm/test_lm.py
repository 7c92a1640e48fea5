import binascii
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from edictum.llm import lm
from edictum.llm.common import held, prepare
from edictum.llm.trie import EliasFano, NgramTrie, counts_of, quantise

SCHEMA = "doc_id bigint, text string, held string, score string, block bigint"


@given(st.lists(st.integers(0, 5000) | st.integers(0, 1 << 45), max_size=80))
@settings(max_examples=80, deadline=None)
def test_elias_fano_against_the_list(values):
    values = sorted(values)
    e, _ = EliasFano.of_buffer(EliasFano.build(np.array(values, np.uint64)).to_bytes(), 0)
    assert e.at(np.arange(len(values))).tolist() == values
    asked = [*values, *[v + 1 for v in values], 0, 1 << 50]
    got = e.find(np.array(asked, np.uint64)).tolist()
    for v, place in zip(asked, got):
        assert (place >= 0) == (v in values) and (place < 0 or values[place] == v)


@given(st.dictionaries(st.tuples(st.integers(0, 30), st.integers(0, 30)), st.integers(1, 1000), max_size=120))
@settings(max_examples=60, deadline=None)
def test_trie_against_a_dictionary(grams):
    keys = sorted(grams)
    c, s, n = (np.array(x, np.uint64) for x in ([k[0] for k in keys], [k[1] for k in keys], [grams[k] for k in keys]))
    trie = NgramTrie.of_buffer(NgramTrie.build(c, s, n).to_bytes())
    a, b = (g.ravel().astype(np.uint64) for g in np.meshgrid(np.arange(32), np.arange(32)))
    expected = [int(quantise(np.array([grams[k]]))[0]) + 1 if (k := (x, y)) in grams else 0 for x, y in zip(a.tolist(), b.tolist())]
    assert trie.find(a, b).tolist() == expected


def test_trie_in_a_mapped_file(tmp_path):
    trie = NgramTrie.build(np.array([1, 1, 7], np.uint64), np.array([0, 9, 2], np.uint64), np.array([3, 1, 40]))
    (tmp_path / "trie").write_bytes(trie.to_bytes())
    mapped = NgramTrie.open(str(tmp_path / "trie"))
    assert (mapped.find(np.array([1, 1, 1, 7, 8]), np.array([0, 9, 2, 2, 2])) > 0).tolist() == [True, True, False, True, False]
    n = np.array([1, 2, 3, 17, 1000, 10**9])
    assert (abs(counts_of(quantise(n)) / n - 1) < 0.045).all()


def rows():
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    out = [(i, " ".join(rng.choices(words, k=rng.randint(1, 80))), "x", "y", i) for i in range(120)]
    return [*out, (500, None, None, None, None), (501, "", None, None, None), (502, " \t\n", None, None, None), (None, "w1 W2 É é", None, None, None), (503, "x\x85y x y " * 3000, None, None, None), out[5], out[5]]


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def brute(rows, prior):
    out = lambda d: d is not None and binascii.crc32(str(d).encode()) % 7 == 2
    single, pairs = Counter(), Counter()
    for d, text, *_ in rows:
        if not out(d):
            seen = tokens(text)
            single.update(seen)
            pairs.update(zip(["\n", *seen], seen))
    n, v = sum(single.values()), len(single)
    p = lambda w: (single[w] + 1) / (n + v + 1)
    result = []
    for d, text, *_ in rows:
        seen, score = tokens(text), 0.0
        for a, b in zip(["\n", *seen], seen):
            c = float(counts_of(quantise(np.array([pairs[a, b]])))[0]) if pairs[a, b] else 0.0
            score += math.log10((c + prior * p(b)) / (single[a] + prior))
        result.append((d, out(d), len(seen), sum(single[w] > 0 for w in seen), n, sum(math.log10(p(w)) for w in seen), score))
    return result


@pytest.mark.parametrize("small", [False, True])
def test_scores_against_brute_force(spark, small, monkeypatch):
    prepare(spark)
    if small:
        monkeypatch.setattr(lm, "SHARD_KEYS", 300)
        monkeypatch.setattr(lm, "FAN_OUT", 3)
    docs = spark.createDataFrame(rows(), SCHEMA).withColumn("held_out", held("doc_id", 7, 2))
    scored = lm.score_documents(docs)
    got = sorted(map(tuple, scored.collect()), key=str)
    expected = sorted(brute(rows(), lm.PRIOR), key=str)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:5] == e[:5]
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)
    tries = [NgramTrie.of_buffer(bytes(r.trie)) for r in scored.model.tries.collect()]
    assert len(tries) >= (2 if small else 1)


def test_nothing_learned_and_no_documents(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a b", True)], "doc_id bigint, text string, held_out boolean")
    (row,) = lm.score_documents(docs).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == row.score == 0
    assert lm.score_documents(docs.limit(0)).collect() == []
