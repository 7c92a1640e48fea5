import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from edictum.llm import minhash, simhash
from edictum.llm.common import prepare

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def copy_at(words, share, rng):
    """A copy with words changed, one after the other, as long as the similarity stays at ``share`` or above."""
    out = list(words)
    for _ in range(200):
        tried = list(out)
        tried[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
        if jaccard(" ".join(words), " ".join(tried)) < share:
            break
        out = tried
    return " ".join(out)


def rows():
    rng = random.Random(3)
    line = [f"line{i}" for i in range(30)]
    out = []
    for i in range(300):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))] + line * (i % 2)
        out.append((i, " ".join(words)))
        out.append((1000 + i, copy_at(words, (0.8, 0.85, 0.9, 0.95)[i % 4], rng)))
        out.append((2000 + i, " ".join([*words[: len(words) // 2], *[f"v{rng.randrange(3000)}" for _ in range(len(words) // 2)]])))
    return out


def roots(texts, least=0.8):
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if (not a and not b) or (min(len(a), len(b)) >= least * max(len(a), len(b)) and len(a & b) >= least * len(a | b)):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def test_stage_finds_all_copies_from_four_fifths(spark):
    prepare(spark)
    found = rows()
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(*r, "en", "a", 1) for r in found], SCHEMA), "").collect()}
    by_root = {}
    for (doc_id, _), root in zip(found, roots([t for _, t in found])):
        by_root[root] = min(by_root.get(root, doc_id), doc_id)
    assert kept == set(by_root.values())
    assert kept == {*range(300), *range(2000, 2300)}


def test_shards_and_odd_rows(spark):
    prepare(spark)
    found = rows()[:240]
    found += [(5000, None), (5001, " "), (5002, found[0][1]), (7, "another text under a known id"), (5003, "One two"), (5004, "one  TWO")]
    docs = spark.createDataFrame(found, "doc_id bigint, text string")
    for shard in (minhash.SHARD, 400):
        got = sorted((r.doc_id, r.component_id) for r in minhash.components(docs, shard=shard).collect())
        number = roots([t for _, t in found])
        least = {}
        for (doc_id, _), root in zip(found, number):
            least[root] = min(least.get(root, doc_id), doc_id)
        assert got == sorted((d, least[r]) for (d, _), r in zip(found, number))
    assert minhash.one_of_each(docs.limit(0)).collect() == []


def test_shards_of_one_large_group():
    """Every two shards of a group that falls into many meet, so chains across them hold."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(3000)}" for _ in range(200)]
    texts = [" ".join(words)]
    for _ in range(60):
        words[rng.randrange(200)] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = [minhash.shingle_set(t.encode()) for t in texts]
    own = [i % 3 for i in range(len(sets))]
    links = []
    for a in range(3):
        for b in range(a, 3):
            some = [i for i in range(len(sets)) if own[i] in (a, b)]
            links += minhash.similar_links(some, [sets[i] for i in some], [own[i] for i in some], a != b)
    reach = {0}
    for _ in range(len(sets)):
        reach |= {x for link in links if reach & set(link) for x in link}
    assert reach == set(range(len(sets)))
    assert all(jaccard(texts[a], texts[b]) >= 0.8 for a, b in links)


def test_bands_of_pairs_at_four_fifths():
    rng = np.random.default_rng(4)
    missed = 0
    for _ in range(2000):
        h = rng.integers(0, 1 << 63, 120, np.uint64)
        missed += not set(minhash.band_keys(h[:108])) & set(minhash.band_keys(np.r_[h[12:]]))
    assert missed == 0


def test_simhash_alone_offers_candidates(spark):
    """Without any band, pairs within the radius of their fingerprints still come to the exact check."""
    prepare(spark)
    found = rows()
    docs = spark.createDataFrame(found, "doc_id bigint, text string")
    signed = minhash.signatures(docs).withColumn("bands", F.array().cast("array<bigint>"))
    signed = signed.localCheckpoint()
    rooted = minhash.candidates(signed)
    got = {frozenset((r.a, r.b)) for r in minhash.checked_links(docs, signed, rooted).collect()}
    of = {r.doc_id: (r.node, r.fp & (2**64 - 1)) for r in signed.collect()}
    near = {i for i in range(300) if (of[i][1] ^ of[1000 + i][1]).bit_count() <= simhash.RADIUS}
    assert len(near) > 60
    assert got == {frozenset((of[i][0], of[1000 + i][0])) for i in near if of[i][0] != of[1000 + i][0]}
    texts = dict(found)
    assert all(jaccard(texts[i], texts[1000 + i]) >= 0.8 for i in near)
