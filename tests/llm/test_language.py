import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from edictum.llm import language
from edictum.llm.common import prepare


def brute_phrases(sample, text):
    """Greedy parse of code sequences by searching the sample."""
    sample, text, at, n = sample.tobytes(), text.tobytes(), 0, 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at, n = at + max(1, size), n + 1
    return n


@given(st.text("abc dé", max_size=60), st.text("abcé x", min_size=1, max_size=40), st.lists(st.text("abcdé xz", max_size=80), max_size=5))
@settings(max_examples=80, deadline=None)
def test_phrases_against_brute_force(one, two, texts):
    parser = language.Parser({"one": one, "two": two})
    codes = [parser.codes(language.points_of(t)) for t in texts]
    samples = [parser.codes(language.points_of(s)) for s in (one, two)]
    expected = [[brute_phrases(s, c) for s in samples] for c in codes]
    assert parser.phrases(codes).tolist() == expected


def test_segments(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 16)
    parser = language.Parser({"x": "abracadabra abra"})
    text = parser.codes(language.points_of("abracadabra" * 9))
    sample = parser.codes(language.points_of("abracadabra abra"))
    expected = sum(brute_phrases(sample, text[a : a + 16]) for a in range(0, len(text), 16))
    assert parser.phrases([text]).tolist() == [[expected]]


def made(lang, n, seed):
    rng = random.Random(seed)
    parts = {"aa": "ka lo mi tu re".split(), "bb": "sch ung ein ber ent".split(), "cc": "ção mente dos das que".split(), "日": "日本語 の文 章で す東京".split()}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_held_out_accuracy(spark):
    prepare(spark)
    rows = [(i, made(lang, 30, 10 * i + k), lang) for i in range(60) for k, lang in enumerate(["aa", "bb", "cc", "日"])]
    rows = [(4 * i + k, t, lang) for k, (i, t, lang) in enumerate(rows)]
    learned = spark.createDataFrame(rows[:120], "doc_id bigint, text string, lang string")
    samples = language.learn(learned)
    assert set(samples) == {"aa", "bb", "cc", "日"}
    assert samples == language.learn(learned.orderBy("text"))
    new = spark.createDataFrame([(d, True, t, lang) for d, t, lang in rows[120:]], "doc_id bigint, held_out boolean, text string, lang string")
    truth = {d: lang for d, _, lang in rows}
    got = language.predict_languages(new, samples).collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(spark):
    prepare(spark)
    texts = [None, "", "123 !!", "\U0001f600", "a", "ka lo " * 20_000, "\U00020000\U00020001", "ka lo mi"]
    rows = [(i or None, False, t, "xx", 0.5) for i, t in enumerate(texts)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, held_out boolean, text string, lang_pred string, score double")
    got = language.predict_languages(frame, {"aa": made("aa", 50, 1), "bb": made("bb", 50, 2)}).collect()
    assert len(got) == len(rows)
    assert [r.lang_pred for r in got[:4]] == ["und"] * 4
    assert [got[5].lang_pred, got[7].lang_pred] == ["aa", "aa"] and got[6].lang_pred in ("aa", "bb")
    assert {r.lang_pred for r in language.predict_languages(frame, {}).collect()} == {"und"}
    nothing = spark.createDataFrame([(1, None, "aa"), (2, "x", None), (None, "", "bb")], "doc_id bigint, text string, lang string")
    assert language.learn(nothing) == {}
    assert language.predict_languages(frame.limit(0), {"aa": "ka"}).collect() == []
