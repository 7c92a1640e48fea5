import random

import numpy as np

from edictum.llm import chunks
from edictum.llm.common import prepare

SCHEMA = "doc_id bigint, text string, owner string, place string, digest string"


def test_gear_hash_one_byte_after_another():
    data = np.random.default_rng(2).integers(0, 256, 300).astype(np.uint8)
    h, expected = 0, []
    for b in data.tolist():
        h = (2 * h + int(chunks.GEAR[b])) & 0xFFFF
        expected.append(h)
    assert chunks.gear_hashes(data).tolist() == expected


def test_cuts_cover_the_text_and_resist_insertions():
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(5000)}é" for _ in range(800)).encode()
    ends = chunks.cuts(np.frombuffer(text, np.uint8)).tolist()
    assert ends == sorted(set(ends)) and ends[-1] == len(text)
    assert max(np.diff([0, *ends])) <= chunks.LONGEST
    for e in ends[:-1]:
        text[:e].decode()
    moved = text[:2000] + b"some words put in" + text[2000:]
    other = {e - 17 for e in chunks.cuts(np.frombuffer(moved, np.uint8)).tolist() if e > 2100}
    assert other >= {e for e in ends if e > 2100}
    for odd in (b"", b"a", b"a" * 1000, "日本".encode() * 500):
        ends = chunks.cuts(np.frombuffer(odd, np.uint8)).tolist()
        assert (ends[-1:] or [0]) == [len(odd)] and max(np.diff([0, *ends]), default=0) <= chunks.LONGEST


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(n))


def brute(rows, least):
    """Runs of chunks that a smaller id has too, document by document."""
    def parts(text):
        data = (text or "").encode()
        ends = chunks.cuts(np.frombuffer(data, np.uint8)).tolist()
        return [(a, b, data[a:b]) for a, b in zip([0, *ends], ends)], data

    owner, texts = {}, {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            texts[doc_id] = text
            for _, _, piece in parts(text)[0]:
                owner[piece] = min(owner.get(piece, doc_id), doc_id)
    found = []
    for doc_id, text in texts.items():
        pieces, data = parts(text)
        run = []
        for a, b, piece in [*pieces, (None, None, None)]:
            if piece is not None and owner[piece] < doc_id:
                run.append((a, b, owner[piece]))
                continue
            if run:
                begins = sum(not data[i : i + 1].isspace() and (i == 0 or data[i - 1 : i].isspace()) for i in range(run[0][0], run[-1][1]))
                if begins >= least:
                    found.append((doc_id, run[0][0], run[-1][1], begins, len(run), sorted({r[2] for r in run})))
            run = []
    return sorted(found)


def rows():
    shared, line = words(55, 100), words(6, 101)
    out = [(i, " ".join([words(40, i), line, words(30, 50 + i)]), "x", "y", None) for i in range(12)]
    out += [(20 + i, " ".join([words(20 + i, 200 + i), shared, words(25, 300 + i)]), None, None, None) for i in range(5)]
    out += [(30, out[3][1], None, None, None), (31, words(4, 400) + " " + out[3][1], None, None, None)]
    out += [(40, None, None, None, None), (41, "", None, None, None), (None, out[3][1], None, None, None), (50, words(20_000, 999), None, None, None), (51, words(20_000, 999), None, None, None)]
    return [*out, out[14], out[14]]


def test_passages_against_brute_force(spark):
    prepare(spark)
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = sorted((r.doc_id, r.first_byte, r.end_byte, r.words, r.n_chunks, r.kept_in) for r in chunks.repeated_passages(docs).collect())
    assert got == brute(rows(), chunks.LEAST_WORDS)
    # Every later holder of the shared passage of 55 words, and every copy, is there; no other document.
    assert {g[0] for g in got} == {21, 22, 23, 24, 30, 31, 51}
    assert chunks.repeated_passages(docs.limit(0)).collect() == []


def test_hot_digests_dealt_out_or_not(spark, monkeypatch):
    """One line begins two thirds of the documents: the same rows whether its chunks are dealt out or stay together."""
    prepare(spark)
    line = words(30, 7)
    docs = spark.createDataFrame([(i, (line + " " if i % 3 else "") + words(10, 1000 + i)) for i in range(300)], "doc_id bigint, text string")
    found = []
    for share in (1024, 8, 1):
        monkeypatch.setattr(chunks, "SHARE", share)
        found.append(sorted(map(tuple, chunks.repeated_passages(docs).collect())))
    assert found[0] == found[1] == found[2] and {r[0] for r in found[0]} == {i for i in range(300) if i % 3 and i > 1}


def test_passages_of_50_to_60_words_are_found(spark):
    """400 passages, each in two documents between words of their own, held against where they were put."""
    prepare(spark)
    rng, planted, docs = random.Random(4), {}, []
    for i in range(400):
        passage = words(rng.randint(50, 60), 5000 + i)
        for copy in range(2):
            before = words(rng.randint(1, 40), 10_000 + 2 * i + copy)
            docs.append((2 * i + copy, f"{before} {passage} {words(20, 20_000 + 2 * i + copy)}"))
        planted[2 * i + 1] = (len(before) + 1, len(before) + 1 + len(passage))
    docs += [(10_000 + i, words(120, 40_000 + i)) for i in range(100)]
    rows = chunks.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in rows} <= set(planted)
    for r in rows:
        assert planted[r.doc_id][0] - 12 <= r.first_byte and r.end_byte <= planted[r.doc_id][1] + 12
        assert r.words <= 62 and r.kept_in == [r.doc_id - 1]
    assert len({r.doc_id for r in rows}) >= 0.99 * len(planted)


def test_cut_texts(spark):
    prepare(spark)
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = chunks.without_repeats(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    before = {r[0]: r[1] for r in rows()}
    assert texts[30] == "" and texts[51] == "" and texts[40] is None
    for i in [*range(12), 20, 50, None]:
        assert texts[i] == before[i]
    assert 0 < len(texts[22]) < len(before[22])
