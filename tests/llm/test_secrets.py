import hashlib
import math
import random
import re
import string
from collections import Counter, defaultdict

import pytest

from edictum.llm import secrets
from edictum.llm.common import prepare

SCHEMA = "doc_id bigint, text string, row int, start bigint, spans string"
KEY = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
RUN = re.compile(r"[A-Za-z0-9+/_-]+")


def brute_base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in KEY.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def brute_tokens(text):
    """Whole runs of symbols outside assignments, as (start, end, string)."""
    at = 0
    blanked = ""
    for m in KEY.finditer(text):
        blanked += text[at : m.start()] + " " * (m.end() - m.start())
        at = m.end()
    blanked += text[at:]
    out = []
    for m in RUN.finditer(blanked):
        run = m.group()
        if len(run) < 16 or not re.search("[0-9]", run) or not re.search("[A-Za-z]", run) or re.search("[0-9a-f]{24}|AKIA[A-Z0-9]{16}", run):
            continue
        end = m.end()
        end += len(re.match("={0,2}", blanked[end:]).group())
        out.append((m.start(), end, blanked[m.start() : end]))
    return out


def tail(z):
    return 0.5 * math.erfc(z / math.sqrt(2))


def brute_test(token):
    """(encoding, symbols, p) from the definitions, with exact tails."""
    body = token.rstrip("=")
    for name, pattern, alphabet, (low, high) in secrets.ENCODINGS:
        if re.search(pattern, body):
            break
    body = body.lower() if len(alphabet) < 40 else body.translate(str.maketrans("-_", "+/"))
    x = [alphabet.index(c) for c in body]
    n, k = len(x), len(alphabet)
    chi = sum((c - n / k) ** 2 / (n / k) for c in Counter(x).values()) + (k - len(set(x))) * n / k
    df = k - 1
    p1 = tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    marks = [low <= v < high for v in x]
    runs, f = 1 + sum(a != b for a, b in zip(marks, marks[1:])), (high - low) / k
    m = 2 * f * (1 - f)
    p2 = 2 * tail(abs(runs - 1 - (n - 1) * m) / math.sqrt((n - 1) * m * (1 - m) + 2 * (n - 2) * (f * (1 - f) - m * m)))
    mean = sum(x) / n
    r = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / sum((a - mean) ** 2 for a in x)
    p3 = 2 * tail(abs(r + 1 / n) * math.sqrt(n))
    h = -sum(math.log(min(max(p, 1e-30), 1)) for p in (p1, p2, p3))
    return name, n, math.exp(-h) * (1 + h + h * h / 2)


def brute_cuts(tested):
    """The lowest per cent at which few enough of the strings above it are not random."""
    strata = defaultdict(list)
    for token in tested:
        name, n, p = brute_test(token)
        strata[name, sum(n >= c for c in secrets.LENGTHS[1:])].append(min(int(p * 100), 99))
    cuts = {}
    for key, bins in strata.items():
        random_ones = 2 * sum(b >= 50 for b in bins)
        for cut in range(1, 51):
            above = sum(b >= cut for b in bins)
            if above and above - random_ones * (100 - cut) / 100 <= secrets.RATE * above:
                cuts[key] = cut / 100
                break
    return cuts


def fixture(seed=5):
    rng = random.Random(seed)
    pick = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    b64 = string.ascii_letters + string.digits + "+/"
    named = ["configuration-server-v2", "http2-upgrade-insecure", "sha256_of_the_document", "getElementsByTagName2", "aaaaaaaaaaaaaaaa1", "abcdefghijklmnop1", "internationalization18", "x1x1x1x1x1x1x1x1x1x1", "AAAA-BBBB-CCCC-0000", "path/to/file/number/1"]
    made = [lambda: pick(b64, rng.choice([20, 33, 64])) + rng.choice(["", "=", "=="]), lambda: pick("0123456789abcdef", 20), lambda: pick(string.ascii_uppercase + "234567", 32),
            lambda: pick(string.ascii_lowercase + string.digits, 24), lambda: pick(string.ascii_letters + string.digits, 40), lambda: rng.choice(named), lambda: rng.choice(named) + str(rng.randrange(99))]
    base = ["password=abcdef", 'Secret : "x.y-z_1=="', "API_KEY='short'", "apikey=12345", "token=token:abcdefgh", "TOKEN = é", "passwd:abc", "AKIA" + pick(string.ascii_uppercase, 16), "AKIAshort", "AKIAAKIA" + "B2" * 9,
            pick("0123456789abcdef", 24), pick("0123456789abcdef", 23), pick("0123456789abcdef", 64), "tokentoken=abcdefg", "password=password=abcdefg", "my_secret_token2=" + pick(b64, 30), "ſecret=abcdefg", "toKen=abcdefg"]
    texts = []
    for _ in range(150):
        words = [rng.choice([lambda: pick("abcdefgh", 5), lambda: "naïve 🙂 日本", rng.choice(made), lambda: rng.choice(base)])() for _ in range(rng.randint(0, 14))]
        texts.append(rng.choice([" ", "\n", ", "]).join(words))
    return texts


def expected(texts):
    tokens = [brute_tokens(t or "") for t in texts]
    cuts = brute_cuts({s for found in tokens for *_, s in found})
    rows = []
    for text, found in zip(texts, tokens):
        base = brute_base(text or "")
        more = []
        for start, end, token in found:
            name, n, p = brute_test(token)
            if p >= cuts.get((name, sum(n >= c for c in secrets.LENGTHS[1:])), 2):
                more.append((start, 3, end, "random"))
        line = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        counts = Counter(k for *_, k in base)
        rows.append((counts["assign"], counts["access"], counts["hex"], hashlib.sha256(line(base).encode()).hexdigest(), line(base + more)))
    return rows


def test_report_against_regular_expressions_and_definitions(spark):
    prepare(spark)
    texts = [*fixture(), None, "", " "]
    rows = [(i, t, 1, 2, "x") for i, t in enumerate(texts)] + [(None, texts[0], 1, 1, ""), (4, texts[1], 1, 1, ""), (4, texts[1], 1, 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(map(tuple, secrets.secret_report(docs).collect()), key=str)
    assert got == sorted(((r[0], *x) for r, x in zip(rows, expected([r[1] for r in rows]))), key=str)
    assert sum("random" in r[-1] for r in got) > 30
    for r in secrets.scan_secrets(docs).collect():
        for s in r.spans:
            assert s.text in {t[s.start : s.end] for t in texts if t} and (s.p is not None) == (s.kind == "random")
    assert secrets.secret_report(docs.limit(0)).collect() == []


def test_p_values_are_those_of_the_definitions_and_even_for_random_strings(spark):
    prepare(spark)
    rng = random.Random(1)
    tokens = ["".join(rng.choices(a, k=n)) for _, _, a, _ in secrets.ENCODINGS for n in (20, 40, 200) for _ in range(300)]
    tokens += [t for text in fixture(9) for *_, t in brute_tokens(text)]
    tokens = [t for t in tokens if re.search("[0-9]", t) and re.search("[A-Za-z]", t)]
    rows = secrets.with_randomness(spark.createDataFrame([(t,) for t in tokens], "text string")).collect()
    for r in rows:
        assert (r.encoding, r.symbols, r.p) == (lambda e: (e[0], e[1], pytest.approx(e[2], abs=2e-6)))(brute_test(r.text))
    for name in ("base16", "base64"):
        p = [r.p for r in rows if r.encoding == name and r.symbols == 200]
        assert len(p) > 250 and 0.35 < sum(x > 0.5 for x in p) / len(p) < 0.65
    words = [r.p for r in rows if r.text in ("configuration-server-v2", "abcdefghijklmnop1", "internationalization18", "aaaaaaaaaaaaaaaa1")]
    assert max(words) < 0.1


def test_many_matches_in_one_text(spark):
    prepare(spark)
    text = "é token=abcdef " * 3000
    (row,) = secrets.secret_report(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    spans = ",".join(f"assign:{15 * i + 2}:{15 * i + 14}" for i in range(3000))
    assert row.n_assign == 3000 and row.spans == spans


def test_no_python_in_the_plan(spark):
    plan = secrets.secret_report(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
