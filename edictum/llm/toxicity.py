"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edictum.functions.names import fresh
from edictum.llm.common import bounded_sample, stage, table, unstage, utf8, words_of

# Bounds of what is learned from: documents confirmed toxic, unlabelled ones, words.
POSITIVES = 4_000
UNLABELLED = 8_000
FEATURES = 2_048
LEAST_Z = 4.0  # a word counts if its share differs by so many standard errors


class Model(NamedTuple):
    weights: dict[bytes, float]
    bias: float
    prior: float


def fit(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, prior: float, n_features: int, steps: int = 600, rate: float = 0.1, decay: float = 2e-5) -> tuple[np.ndarray, float]:
    """Logistic weights that minimise the non-negative PU risk, full batches, Adam.

    ``rows``/``cols`` name the words that each document has; ``positive`` marks the toxic documents,
    the others are unlabelled. The risk is prior * R+(P) + max(0, R-(U) - prior * R-(P)), with
    logistic losses log(1 + exp(-m)) and log(1 + exp(m)). Where the part in brackets falls below
    zero the step goes against it, so that toxic documents among the unlabelled ones are not
    learned by heart as harmless.
    """
    n, n_pos = len(positive), max(1, int(positive.sum()))
    n_unl = max(1, n - int(positive.sum()))
    w, first, second = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        margin = np.bincount(rows, w[cols], n) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        # The losses' slopes are p - 1 and p.
        minus = np.logaddexp(0, margin)
        rest = minus[~positive].sum() / n_unl - prior * minus[positive].sum() / n_pos
        slope = np.where(positive, -prior * p / n_pos, p / n_unl)  # of the part in brackets
        if rest < 0:
            slope = -slope
        else:
            slope = slope + np.where(positive, prior * (p - 1) / n_pos, 0)
        grad = np.append(np.bincount(cols, slope[rows], n_features), slope.sum())
        grad[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return w[:-1], float(w[-1])


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [sorted(set(words_of(t.as_py()))) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.binary()))], ["positive", "words"])


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model:
    """Learn from documents and labels (doc_id, toxic); both already without what is held out.

    A document is confirmed toxic if any of its labels says so. Unlabelled text is drawn from all
    documents, labels hidden; the prior is the toxic share of the labelled documents. Samples are
    by hashed id and bounded, so only bounded tables reach the driver. Without a toxic document, or
    without any other, the model scores every text with the prior alone.
    """
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    known = marks.join(ids, "doc_id", "left_semi")
    share = known.agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("k")).first()
    prior = min(0.9, max(0.001, share.k / share.n)) if share.n else 0.001
    toxic = bounded_sample(known.where("toxic").select("doc_id"), None, "doc_id", positives).select("doc_id", F.lit(True).alias("positive"))
    other = bounded_sample(ids.select("doc_id"), None, "doc_id", unlabelled, seed=29).select("doc_id", F.lit(False).alias("positive"))
    chosen = stage(toxic.unionByName(other).distinct(), "tox-ids")
    # At most 2 * (positives + unlabelled) ids.
    texts = docs.select("doc_id", utf8().alias("text")).join(F.broadcast(chosen), "doc_id").select("positive", "text")
    sample = stage(texts.mapInArrow(_distinct_words, "positive boolean, words array<binary>"), "tox-words")
    counts = {r.positive: r.n for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_unl = counts.get(True, 0), counts.get(False, 0)
    if not n_pos or not n_unl:
        return Model({}, float(np.log(prior / (1 - prior))), prior)
    per_word = sample.select("positive", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if("positive").alias("a"), F.count_if(~F.col("positive")).alias("b")
    )
    both = (F.col("a") + F.col("b")) / F.lit(float(n_pos + n_unl))
    gap = F.col("a") / F.lit(float(n_pos)) - F.col("b") / F.lit(float(n_unl))
    error = F.sqrt(both * (F.lit(1.0) - both) * F.lit(1 / n_pos + 1 / n_unl)) + F.lit(1e-9)
    z = F.abs(gap) / error
    best = per_word.where("a + b >= 5").where(z >= LEAST_Z).orderBy(z.desc(), "word").limit(features).select("word")
    vocabulary = {bytes(r.word): i for i, r in enumerate(best.collect())}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[vocabulary[w] for w in words if w in vocabulary] for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["positive", "places"])

    listed = sample.mapInArrow(places, "positive boolean, places array<int>").toArrow()
    unstage(sample)
    unstage(chosen)
    positive = listed.column(0).to_numpy().astype(bool)
    per_doc = listed.column(1).to_pylist()
    # The order of rows from the cluster is not fixed; the sum that is minimised does not depend on it.
    order = sorted(range(len(per_doc)), key=lambda i: (positive[i], per_doc[i]))
    rows = np.repeat(np.arange(len(order)), [len(per_doc[i]) for i in order])
    cols = np.array([c for i in order for c in per_doc[i]], np.int64)
    weights, bias = fit(rows, cols, positive[order], prior, len(vocabulary))
    return Model({w: float(weights[i]) for w, i in vocabulary.items()}, bias, prior)


def scorer(model: Model):
    """Score of a text's bytes: probability that label 1 is right."""
    weights, known, bias = model.weights, frozenset(model.weights), model.bias

    def score(text: bytes) -> float:
        margin = bias + sum(weights[w] for w in sorted(known.intersection(words_of(text))))
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, margin)))))

    return score


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) from rows of (doc_id, held_out, text).

    One narrow pass over whole texts. A NULL or empty text is scored by the bias; repeated rows give
    repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            scores = [score(t.as_py()) for t in batch.column(2)]
            yield table({"doc_id": batch.column(0), "held_out": batch.column(1), "score": scores, "predicted": [int(s >= 0.5) for s in scores]}, _SCORED)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", utf8().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is under one half, all columns as they were, whatever their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            keep = [score(t.as_py()) < 0.5 for t in batch.column(batch.num_columns - 1)]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], schema=pa.schema(list(kept.schema)[:-1]))

    (scored,) = fresh(docs, "utf8")
    return docs.withColumn(scored, utf8()).mapInArrow(run, docs.schema)
