import binascii

import numpy as np

from edictum.llm import toxicity
from edictum.llm.common import held, prepare, words_of

SCHEMA = "doc_id bigint, held_out boolean, text string, label string, positive string"


def corpus(n=900):
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, 40))
        toxic = i % 6 == 0
        if toxic:
            text[3:6] = rng.choice(["vile", "awful", "rotten"], 3)
        docs.append((i, " ".join(text)))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_toxic_documents_are_found(spark):
    prepare(spark)
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("held_out", held("doc_id", 5, 0))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").where(~held("doc_id", 5, 0))
    model = toxicity.learn(frame.where("NOT held_out"), marks)
    assert 0.1 < model.prior < 0.25
    rows = toxicity.score_documents(frame, model).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    right = [r.predicted == int(r.doc_id % 6 == 0) for r in rows if r.held_out]
    assert np.mean(right) > 0.95
    again = toxicity.learn(frame.where("NOT held_out"), marks)
    assert again == model


def brute_score(model, text):
    margin = model.bias + sum(model.weights.get(w, 0.0) for w in set(words_of((text or "").encode())))
    return 1 / (1 + np.exp(-margin))


def test_scores_and_edge_rows(spark):
    prepare(spark)
    model = toxicity.Model({b"vile": 4.0, b"nice": -1.0}, -2.0, 0.1)
    texts = [None, "", "VILE!!", "nice vile", "x " * 50_000 + "vile", "vile vile", "!!"]
    rows = [(i or None, False, t, "toxic", "p") for i, t in enumerate(texts)] + [(2, True, "VILE!!", None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = toxicity.score_documents(frame, model).collect()
    assert len(got) == len(rows)
    for r, (doc_id, held_out, text, *_) in zip(got, rows):
        assert (r.doc_id, r.held_out) == (doc_id, held_out)
        assert abs(r.score - brute_score(model, text)) < 1e-9
    kept = toxicity.without_toxic(frame, model)
    assert kept.columns == frame.columns
    assert sorted(map(str, kept.collect())) == sorted(str(spark.createDataFrame([r], SCHEMA).first()) for r in rows if brute_score(model, r[2]) < 0.5)


def test_nothing_to_learn_from(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id bigint, text string").selectExpr("*", "false AS held_out")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(None, 1), (7, None), (8, 1)], "doc_id bigint, toxic int")
    for labels in (none, odd):
        model = toxicity.learn(docs, labels)
        assert model.weights == {}
        assert [r.predicted for r in toxicity.score_documents(docs, model).collect()] == [0, 0]
    assert toxicity.learn(docs.limit(0), odd).weights == {}


def test_risk_does_not_learn_the_hidden_positives_as_harmless():
    """Half of the unlabelled documents are toxic too: they must still score high."""
    rng = np.random.default_rng(0)
    kinds = np.array([1] * 50 + [1] * 50 + [0] * 50)
    positive = np.arange(150) < 50
    rows, cols = [], []
    for i, k in enumerate(kinds):
        for c in rng.choice(10, 3, replace=False) + (0 if k else 10):
            rows.append(i)
            cols.append(c)
    rows, cols = np.array(rows), np.array(cols)
    w, b = toxicity.fit(rows, cols, positive, 0.5, 20)
    margin = np.bincount(rows, w[cols], 150) + b
    assert (margin[50:100] > 0).all() and (margin[100:] < 0).all()
