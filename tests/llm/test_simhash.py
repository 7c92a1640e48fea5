import random

import numpy as np
from pyspark.sql import functions as F

from edictum.llm import simhash
from edictum.llm.common import prepare
from edictum.llm.components import connected

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, root int"


def brute_print(text, spark):
    import re

    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [r.h % (1 << 64) for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_against_spark_hash(spark):
    for text in (None, "", " \t", "One", "one TWO three", "a b c d", "É é a B c\x0bd\x85e f　g h i", "x y z " * 40):
        assert simhash.fingerprint((text or "").encode()) == brute_print(text, spark), text


def clustered(n, seed):
    rng = random.Random(seed)
    prints = set()
    while len(prints) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 8, 30])):
            x = centre
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    return sorted(prints)


def brute_roots(prints, radius):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def parts(roots):
    found = {}
    for node, root in roots.items():
        found.setdefault(root, set()).add(node)
    return sorted(map(sorted, found.values()))


def test_tree_finds_all_pairs():
    prints = np.array(clustered(300, 1), np.uint64)
    tree = simhash.BKTree(prints)
    for radius in (0, 3, 6):
        got = sorted((int(q), int(n)) for qs, ns in tree.within(prints, radius) for q, n in zip(qs, ns))
        assert got == sorted((i, j) for i in range(len(prints)) for j in range(len(prints)) if (int(prints[i]) ^ int(prints[j])).bit_count() <= radius)


def test_links_join_what_is_near(spark):
    prepare(spark)
    prints = clustered(500, 2)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    for shard in (simhash.SHARD, 3):
        roots = {p: p for p in signed} | {r.node: r.root for r in connected(simhash.near_links(frame, shard=shard)).collect()}
        got = {p: r % (1 << 64) for p, r in zip(prints, (roots[s] for s in signed))}
        assert parts(got) == parts(brute_roots(prints, 4))


def test_components_of_a_long_chain_and_a_star(spark):
    prepare(spark)
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 400)] + [(2000, 1005), (2000, 2000)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(chain + star, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(301))
    assert got[2000] == 1000 and got[1399] == 1000
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def texts():
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(120)) for _ in range(12)]
    near = [b.replace(" ", "  ", 3).upper() for b in base[:4]] + [" ".join([*b.split()[:-1], "other"]) for b in base[:6]]
    return [*base, *near, None, "", "  ", base[0], base[0], "short text", "Short  text", " ".join(["long"] * 40_000)]


def rows():
    out = [(100 - i, t, "en", None, None, "x", 1) for i, t in enumerate(texts())]
    return [*out, (None, texts()[0], None, None, None, None, None), (None, "nobody else has this text", None, None, None, None, None), out[2]]


def test_documents_against_brute_force(spark):
    prepare(spark)
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = simhash.report(docs).collect()
    prints = {t: simhash.fingerprint((t or "").encode()) for t in {r[1] for r in rows()}}
    roots = brute_roots(sorted(set(prints.values())), 4)
    least = {}
    for doc_id, text, *_ in rows():
        root = roots[prints[text]]
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    expected = [(d, f"{prints[t]:016x}", least[roots[prints[t]]]) for d, t, *_ in rows()]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)

    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for d, _, c in expected if d is not None})
    assert ids.count(None) == 2
    assert simhash.report(docs.limit(0)).collect() == [] and simhash.one_of_each(docs.limit(0)).collect() == []
