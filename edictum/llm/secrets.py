"""Secrets in texts: assignments and known shapes, and strings that pass for random."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.llm.common import stage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_VALUE = 6
#: kind, pattern, characters of a match at least
SHAPES = [("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]{24,}+", 24)]
KINDS = ["assign", "access", "hex", "random"]

SYMBOL = "[A-Za-z0-9+/_-]"
#: A whole run of 16 symbols or more with a letter and a digit, without a match of SHAPES in it.
TOKEN = (
    rf"(?<!{SYMBOL})(?={SYMBOL}{{16}})(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])"
    rf"(?!{SYMBOL}*?(?:[0-9a-f]{{24}}|AKIA[A-Z0-9]{{16}})){SYMBOL}++={{0,2}}"
)
#: encoding, what all its strings match, its alphabet, and the part of it whose runs are counted.
#: A string has the first encoding that fits.
ENCODINGS = [
    ("base16", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", (0, 10)),
    ("base32", "^([a-z2-7]+|[A-Z2-7]+)$", "abcdefghijklmnopqrstuvwxyz234567", (26, 32)),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz", (0, 10)),
    ("base62", "^[0-9A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", (26, 52)),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", (26, 52)),
]
#: Shortest length of each class: strings are judged among strings of their length.
LENGTHS = [16, 20, 24, 32, 48, 96]
BINS = 100
RATE = 0.1  # strings taken for random by mistake, of those taken
UPPER_HALF = 0.5  # where hardly any but random strings are


def _running(sizes: Column, block: int = 256) -> Column:
    """The sum of the elements before each, so many at a time that a long array stays cheap."""
    zero = F.lit(0).cast("bigint")

    def cumulate(values: Column, start: Column) -> Column:
        state = F.struct(F.array().cast("array<bigint>").alias("out"), start.alias("at"))
        step = lambda s, x: F.struct(F.concat(s["out"], F.array(s["at"])).alias("out"), (s["at"] + x).alias("at"))
        return F.aggregate(values, state, step, lambda s: s["out"])

    last = F.floor((F.size(sizes) - 1) / F.lit(block)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * block + 1, block))
    sums = F.transform(blocks, lambda v: F.aggregate(v, zero, lambda s, x: s + x))
    return F.flatten(F.zip_with(blocks, cumulate(sums, zero), cumulate))


SPANS = "array<struct<start:bigint,end:bigint,text:string>>"


def with_matches(df: DataFrame, name: str, text: str, pattern: str) -> DataFrame:
    """Add all matches of a pattern as (start, end, text), in code points, with what stands between them.

    Matches and the text between them come from the same search; their lengths add up to places. A
    match is never empty.
    """
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gaps"))
    found = F.when(F.regexp_like(text, F.lit(pattern)), found)
    sizes = F.zip_with(F.col("_at.m"), F.slice("_at.gaps", F.lit(1), F.size("_at.m")), lambda m, g: (F.length(m) + F.length(g)).cast("bigint"))
    span = lambda e: F.struct(e["before"] + F.length(e["gap"]), e["before"] + F.length(e["gap"]) + F.length(e["m"]), e["m"])
    rows = F.arrays_zip(F.col("_at.m").alias("m"), F.slice("_at.gaps", F.lit(1), F.size("_at.m")).alias("gap"), F.col("_before").alias("before"))
    df = df.withColumn("_at", found).withColumn("_before", F.when(F.col("_at").isNotNull(), _running(sizes)))
    spans = F.when(F.col("_at").isNotNull(), F.transform(rows, span).cast(SPANS)).otherwise(F.array().cast(SPANS))
    return df.withColumn(name, spans).withColumn(f"{name}_gaps", F.col("_at.gaps")).drop("_at", "_before")


def _upper_tail(z: Column) -> Column:
    """P(N > z) of a standard normal. The published rational approximation of five terms."""
    a = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + a * F.lit(0.2316419))
    poly = reduce(lambda s, c: (s + F.lit(c)) * t, (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530), F.lit(0.0))
    tail = F.exp(-a * a / F.lit(2.0)) * F.lit(0.3989422804014327) * poly
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def with_randomness(tokens: DataFrame) -> DataFrame:
    """Add ``encoding``, ``symbols`` and ``p``: how likely a random string of the encoding looks no more random.

    Three tests of independent, equally frequent symbols: chi-squared of the symbol counts, by the
    approximation of Wilson and Hilferty; the number of runs of one part of the alphabet (digits, or small
    letters); the correlation of neighbours. Fisher's method puts the three together. Reads ``text``.
    """
    body, lit = F.rtrim(F.col("text"), F.lit("=")), lambda v: F.lit(float(v))
    number = F.lit(len(ENCODINGS) - 1)
    for i in reversed(range(len(ENCODINGS) - 1)):
        number = F.when(F.regexp_like(body, F.lit(ENCODINGS[i][1])), F.lit(i)).otherwise(number)
    by = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("e") + 1)
    one_case = [len(a) < 40 for _, _, a, _ in ENCODINGS]
    plain = F.when(by(one_case), F.lower(body)).otherwise(F.translate(body, "-_", "+/"))
    alphabet = by([a for _, _, a, _ in ENCODINGS])
    places = F.transform(F.filter(F.split(F.col("plain"), ""), lambda c: c != ""), lambda c: (F.instr(F.col("alphabet"), c) - 1).cast("double"))
    rows = tokens.withColumn("e", number).withColumn("plain", plain).withColumn("alphabet", alphabet).withColumn("x", places)

    # Equal symbols stand together: the r-th of them adds 2 r - 1 to the sum of squared counts.
    none = F.struct(lit(-1).alias("v"), lit(0).alias("r"), lit(0).alias("sum"))

    def count(s: Column, v: Column) -> Column:
        r = F.when(v == s["v"], s["r"] + 1.0).otherwise(lit(1))
        return F.struct(v.alias("v"), r.alias("r"), (s["sum"] + 2.0 * r - 1.0).alias("sum"))

    squares = F.aggregate(F.array_sort("x"), none, count, lambda s: s["sum"])
    low, high = by([float(r[0]) for *_, r in ENCODINGS]), by([float(r[1]) for *_, r in ENCODINGS])
    fields = ["v", "c", "runs", "s1", "s2", "s11"]
    begin = F.struct(*[lit(-1 if f in "vc" else 0).alias(f) for f in fields])

    def walk(s: Column, v: Column) -> Column:
        c = F.when((v >= F.col("low")) & (v < F.col("high")), lit(1)).otherwise(lit(0))
        turn = F.when(c == s["c"], lit(0)).otherwise(lit(1))
        pair = F.when(s["v"] < 0, lit(0)).otherwise(s["v"] * v)
        values = [v, c, s["runs"] + turn, s["s1"] + v, s["s2"] + v * v, s["s11"] + pair]
        return F.struct(*[x.alias(f) for f, x in zip(fields, values)])

    rows = rows.withColumn("low", low).withColumn("high", high).withColumn("squares", squares).withColumn("w", F.aggregate("x", begin, walk))
    n, k = F.size("x").cast("double"), F.length("alphabet").cast("double")
    rows = rows.withColumn("n", n).withColumn("k", k)
    n, k, s1 = F.col("n"), F.col("k"), F.col("w.s1")
    part = (F.col("high") - F.col("low")) / k
    df = k - 1.0
    chi = F.col("k") / n * F.col("squares") - n
    z_chi = (F.pow(chi / df, lit(1 / 3)) - (1.0 - 2.0 / (9.0 * df))) / F.sqrt(2.0 / (9.0 * df))
    # A run ends between two symbols with probability m; neighbouring ends are not quite independent.
    m = 2.0 * part * (1.0 - part)
    spread = (n - 1.0) * m * (1.0 - m) + 2.0 * (n - 2.0) * (m / 2.0 - m * m)
    p_runs = 2.0 * _upper_tail(F.abs(F.col("w.runs") - 1.0 - (n - 1.0) * m) / F.sqrt(spread))
    mean = s1 / n
    around = F.col("w.s11") - mean * (2.0 * s1 - F.element_at("x", 1) - F.element_at("x", -1)) + (n - 1.0) * mean * mean
    whole = F.col("w.s2") - n * mean * mean
    z_pairs = (around / whole + 1.0 / n) * F.sqrt(n)
    p_pairs = F.when(whole <= 1e-9, lit(0)).otherwise(2.0 * _upper_tail(F.abs(z_pairs)))
    odds = [F.log(F.least(F.greatest(p, lit(1e-30)), lit(1))) for p in (_upper_tail(z_chi), p_runs, p_pairs)]
    rows = rows.withColumn("h", -(odds[0] + odds[1] + odds[2]))
    p = F.exp(-F.col("h")) * (1.0 + F.col("h") + F.col("h") * F.col("h") / 2.0)
    return rows.select(*tokens.columns, by([name for name, *_ in ENCODINGS]).alias("encoding"), F.size("x").alias("symbols"), p.alias("p"))


def _class(symbols: Column) -> Column:
    return sum((F.when(symbols >= least, F.lit(1)).otherwise(F.lit(0)) for least in LENGTHS[1:]), F.lit(0))


def thresholds(tested: DataFrame, rate: float = RATE) -> DataFrame:
    """(t_encoding, t_length, cut): from which p on a string of an encoding and a length class is called random.

    Random strings have every p equally often, so those above one half tell how many random ones there are,
    and how many of them lie above any cut; what else lies above it is called by mistake. The cut is the
    lowest per cent for which that is at most ``rate`` of the calls. Different strings count once. At most
    one row for each encoding and length class, 30 in all.
    """
    place = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int")
    each = tested.select(F.col("encoding").alias("t_encoding"), _class(F.col("symbols")).alias("t_length"), place.alias("bin"), F.md5("text").alias("digest")).distinct()
    counts = each.groupBy("t_encoding", "t_length", "bin").agg(F.count(F.lit(1)).alias("n"))
    half = int(UPPER_HALF * BINS)
    tried = counts.select("t_encoding", "t_length", "bin", "n", F.explode(F.sequence(F.lit(1), F.lit(half))).alias("cut"))
    above = F.sum(F.when(F.col("bin") >= F.col("cut"), F.col("n")).otherwise(F.lit(0)))
    random = F.sum(F.when(F.col("bin") >= half, F.col("n")).otherwise(F.lit(0))) / F.lit(1 - UPPER_HALF)
    judged = tried.groupBy("t_encoding", "t_length", "cut").agg(above.alias("above"), random.alias("random"))
    mistaken = F.col("above") - F.col("random") * (BINS - F.col("cut")) / F.lit(float(BINS))
    good = judged.where((F.col("above") > 0) & (mistaken <= F.lit(rate) * F.col("above")))
    return good.groupBy("t_encoding", "t_length").agg((F.min("cut") / F.lit(float(BINS))).alias("cut"))


FOUND = "array<struct<start:bigint,place:int,end:bigint,kind:string,text:string,encoding:string,p:double>>"


def _spans(column: str, kind: str) -> Column:
    nothing = [F.lit(None).cast("string"), F.lit(None).cast("double")]
    return F.transform(column, lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)), s["end"], F.lit(kind), s["text"], *nothing)).cast(FOUND)


def scan_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, spans): every secret found in each document, as (start, place, end, kind, text, encoding, p).

    Kinds: ``assign`` (a key and a value), ``access`` and ``hex`` (known shapes), and ``random``, which
    is any other run of 16 symbols or more that the tests of :func:`with_randomness` take for random at the
    given rate of mistakes among strings of its encoding and length. Places are code points, the end is
    exclusive; spans are in order of start, then of kind. Built-in expressions only.

    A document without text has none. Rows are documents, ids may repeat or be NULL; further columns are
    ignored. Texts stay where they are; only the strings that are tested leave their documents.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    rows = with_matches(rows, "assign", "t", ASSIGN)
    value = lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2))
    # Where something is assigned no random string is looked for: blanks stand for it.
    blank = F.zip_with(
        "assign_gaps", F.transform("assign", lambda s: F.repeat(F.lit(" "), (s["end"] - s["start"]).cast("int"))),
        lambda gap, match: F.concat(gap, F.coalesce(match, F.lit(""))),
    )
    rows = rows.withColumn("rest", F.when(F.col("assign_gaps").isNull(), F.col("t")).otherwise(F.array_join(blank, "")))
    base = [_spans("assign_kept", "assign")]
    rows = rows.withColumn("assign_kept", F.filter("assign", lambda s: value(s) >= LEAST_VALUE))
    for kind, pattern, least in SHAPES:
        rows = with_matches(rows, kind, "t", pattern)
        base.append(F.filter(_spans(kind, kind), lambda s, least=least: s["end"] - s["start"] >= least))
    rows = with_matches(rows, "tokens", "rest", TOKEN)
    found = stage(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.array_sort(F.concat(*base)).alias("base"), "tokens"), "found")
    tested = stage(with_randomness(found.select("row", F.inline("tokens"))), "tested")
    cut = F.broadcast(thresholds(tested, rate))
    taken = tested.join(cut, (F.col("encoding") == F.col("t_encoding")) & (_class(F.col("symbols")) == F.col("t_length"))).where("p >= cut")
    one = F.struct("start", F.lit(KINDS.index("random")).alias("place"), "end", F.lit("random").alias("kind"), "text", "encoding", "p")
    more = taken.groupBy(F.col("row").alias("m_row")).agg(F.collect_list(one).cast(FOUND).alias("more"))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(FOUND))))
    return found.join(more, F.col("row") == F.col("m_row"), "left").select("doc_id", spans.alias("spans"))


def secret_report(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined)."""
    found = scan_secrets(docs, rate)
    base = F.filter("spans", lambda s: s["kind"] != "random")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, KINDS[:3]), F.sha2(line(base), 256).alias("base_sha256"), line("spans").alias("spans"))
