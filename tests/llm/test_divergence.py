import random
import re
from collections import Counter, defaultdict

import duckdb

from edictum.llm import divergence
from edictum.llm.common import prepare
from edictum.llm.queries import ORACLES

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, p int"
FOLD = str.maketrans(divergence._UPPER, divergence._LOWER)


def terms_of(text):
    return [t.translate(FOLD) for t in re.findall(r"[A-Za-z\x80-\U0010ffff]+", text or "")]


def brute(rows, least=3, top=200):
    """Every term of every pair of sources, one by one."""
    seen, counts, groups = defaultdict(set), defaultdict(Counter), defaultdict(set)
    for i, (_, text, lang, source, *_) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for t in terms_of(text):
            seen[lang, t].add(i)
            counts[lang, source][t] += 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (g, t), d in seen.items() if g == lang and len(d) >= least]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(p[s][x], p[t][x]) for x in kept), t) for t in sources - {s}]
            own = [(f(p[s][x], q[x]), x) for x in kept if counts[lang, s][x] and p[s][x] > q[x]]
            for part, items in (("pair", pairs), ("term", own)):
                ranked = sorted(items, key=lambda e: (-e[0], e[1].encode()))
                out += [(lang, s, part, x, v, r) for r, (v, x) in enumerate(ranked, 1) if part == "pair" or r <= top]
    return sorted(out)


def fixture(seed):
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[i % 10]}{'xyz'[i % 3]}{'q' * (i // 30)}" for i in range(90)] + ["Éclair", "éclair", "日本", "Straße", "İ", "a-b", "foo,", "Foo", "(foo", "foo/foo", "12", "--", "x\x85y", "x y"]
    rows = []
    for i in range(240):
        lang, source = rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["hot", "hot", "b", "c", None, "", "É"])
        k = rng.choice([0, 1, 3, 12, 40])
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=k)), lang, source, "t", 1))
    rows += [(None, None, "en", "silent", None, None), (3, "", "fr", "alone", None, None), (3, "only here twice twice", "es", "a", None, None), (3, "only here", "es", "b", None, None)]
    rows += [(7, " ".join(f"rare{c}," for c in "abc") * 2, "two", "a", None, None)] * 2 + [(8, "Rarea rarea. (rarea rarea) rareb", "two", "z", None, None)]
    return rows


def test_against_every_term_and_against_sql(spark):
    prepare(spark)
    for seed in (1, 2):
        rows = fixture(seed)
        docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
        got = divergence.audit_sources(docs)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        got = sorted(map(tuple, got.collect()))
        assert got == brute(rows)
        con = duckdb.connect()
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
        assert sorted(con.execute(ORACLES["op13_source_divergence"]).fetchall()) == got


def test_terms_are_cut_at_their_rank_and_documents_are_rows(spark):
    prepare(spark)
    rows = [(i, " ".join(f"a{'bcdefghijk'[k % 10]}{'lmnopqrstu'[k // 10 % 10]}{'vwx'[k // 100]}" for k in range(290)), "en", "big", None, None) for i in range(4)]
    rows += [(9, "other words here", "en", "small", None, None)] * 3
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, divergence.audit_sources(docs).collect()))
    assert got == brute(rows) and max(r[5] for r in got) == 200
    same = spark.createDataFrame([(1, "one text", "en", "a", None, None)] * 3, SCHEMA)
    assert len(divergence.Audit(same).kept.collect()) == 2
    assert divergence.audit_sources(docs.limit(0)).collect() == []


def test_a_term_spread_over_spellings_counts_its_documents_once(spark):
    prepare(spark)
    spell = ["foo", "Foo", "foo,", "(foo", "foo.", "FOO", "foo!"]
    for homes, kept in (([0, 0, 0, 1, 1, 1, 1], 0), ([0, 1, 0, 1, 2, 0, 0], 1), ([0, 0, 0, 0, 0, 0, 0], 0)):
        rows = [(d, " ".join(s for s, h in zip(spell, homes) if h == d), "en", "s", None, None) for d in sorted(set(homes))]
        assert divergence.Audit(spark.createDataFrame(rows, SCHEMA).repartition(3)).kept.count() == kept
