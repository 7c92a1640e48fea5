import random
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from edictum.llm import decontaminate, mixing, simhash, tokens, toxicity
from edictum.llm.common import prepare
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_simhash import brute_roots
from tests.llm.test_toxicity import brute_score

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fixture():
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(4000)}"
    items = [(i, " ".join(word() for _ in range(30))) for i in range(6)]
    docs, labels = [], []
    for i in range(400):
        text = [word() for _ in range(rng.randint(20, 120))]
        toxic = i % 8 == 0
        if toxic:
            text[5:8] = ["vile", "awful", "rotten"]
        if i % 25 == 3:
            text += items[i % 6][1].split()
        docs.append([i, " ".join(text), "en", rng.choice(["a", "a", "a", "b", "c", None]), len(text)])
        if rng.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    for i in range(400, 440):
        docs.append([i, docs[i - 390][1].upper(), "en", "b", 1])
    docs += [[500, None, None, None, None], [501, "", "en", "a", 0], [None, "no id here", "en", "a", 1]]
    return docs, labels, items


def test_run_against_brute_force(spark, tmp_path):
    prepare(spark)
    docs, labels, items = fixture()
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=lambda r: r[1])

    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = toxicity.learn(table, spark.read.parquet(str(tmp_path / "labels.parquet")))
    kept = [d for d in docs if brute_score(model, d[1]) < 0.5]
    gone = {d[0] for d in docs} - {d[0] for d in kept}
    assert {i for i in range(0, 400, 8)} <= gone and len(gone) < 70

    prints = [simhash.fingerprint((d[1] or "").encode()) for d in kept]
    roots = brute_roots(sorted(set(prints)), simhash.RADIUS)
    groups = defaultdict(list)
    for d, p in zip(kept, prints):
        if d[0] is not None:
            groups[roots[p]].append(d)
    kept = [min(g, key=lambda d: d[0]) for g in groups.values()] + [d for d in kept if d[0] is None]
    assert not any(d[0] in range(400, 440) and d[0] - 390 in {k[0] for k in kept} for d in kept)

    leaks = {d for d, *_ in brute_leaks([(d[0], d[1]) for d in kept], items, decontaminate.LEAST)}
    assert len(leaks) >= 10
    kept = [d for d in kept if d[0] not in leaks]

    # Mixing is held against its SQL elsewhere; here its copies must be what goes on.
    frame = spark.createDataFrame(kept, SCHEMA)
    copies = {r.doc_id: r.copies for r in mixing.mix_report(frame).collect()}
    assert Counter(copies.values())[2] > 0
    from tokenizers import Tokenizer

    tok, start, expected = Tokenizer.from_file(tokens.default_tokenizer()), 0, []
    for d in sorted(kept, key=lambda d: (d[0] is not None, d[0] or 0)):
        for _ in range(copies[d[0]]):
            ids = np.array([*tok.encode(d[1] or "", add_special_tokens=False).ids, tokens.END_ID], "<u4")
            expected.append((d[0], start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert got == expected


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    prepare(spark)
    docs, labels, items = fixture()
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(docs[:9], SCHEMA)
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        assert function(spark, none, str(tmp_path)).collect() == []
        if k < 3:
            assert sorted(function(spark, some, str(tmp_path)).collect()) == sorted(some.collect(), key=str) or k == 1
        if k < 4:
            assert function(spark, some, str(tmp_path)).columns == some.columns
