r"""Secret scan with a randomness test battery. DataFrame functions only.

Base patterns (assignments, access keys, hexadecimal runs) are found first. Further candidates are
runs of 20 or more key characters. For each, the encoding is inferred (hex, base32, base62, base64,
base64url) and three tests of "its symbols are uniform and independent" are made over that
alphabet: chi-squared uniformity, Wald-Wolfowitz runs about the middle of the alphabet, and lag-1
serial correlation. The smallest of the three p-values (times three) is the candidate's. Ordinary
text fails these tests, and the longer it is, the more surely: the weighted Benjamini-Hochberg
procedure over all candidates of the corpus, with weights in proportion to length, declares which
candidates are *structured* at a false-discovery rate of ``FDR``, so that hardly any truly random
candidate is set aside by mistake. Those that remain are reported as ``random``. The threshold
comes from a histogram of weighted p-values (one row per bin), so nothing is ranked globally.

Defined results: null or empty text has no spans; repeated rows are scanned alike; a candidate that
overlaps a base span is left to that span; ties in start are ordered by kind; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.llm.common import cut

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"          # the runs of 24 or more among the matches of [0-9a-f]+
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
MIN_ASSIGN, MIN_ACCESS = 6, 20
FDR = 0.01

DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: name, pattern of the whole candidate, alphabet; the first that matches is the encoding.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("HEX", r"^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("base32", r"^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("base62", r"^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", r"^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", r"", UPPER + LOWER + DIGITS + "+/-_"),
)
BINS_PER_DECADE = 4
MAX_BIN = 300 * BINS_PER_DECADE
SCAN_BLOCK = 128        # elements of an array that are scanned together


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a transform of one element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, combine) -> Column:
    """Per element of an array of int, all elements before it combined, from 0 on. Arrays are copied
    where they grow, so they grow in blocks: one scan inside each block, one over the totals."""
    def scan(items, zero):
        start = F.struct(zero.alias("so_far"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, start, lambda a, x: F.struct(
            combine(a["so_far"], x).alias("so_far"),
            F.concat(a["out"], F.array(a["so_far"])).alias("out")), lambda a: a["out"])

    def blocks(values):
        firsts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(SCAN_BLOCK))
        return F.transform(firsts, lambda k: F.slice(values, k, SCAN_BLOCK))

    return _let(values, lambda v: _let(blocks(v), lambda parts: F.flatten(F.zip_with(
        parts, scan(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), combine)), F.lit(0)), scan))))


def _spans(text: Column, pattern: str, kind: str, keep, parts=(0,)) -> Column:
    """Array of ``kind, start, end, match`` of the matches that ``keep`` accepts. The pieces
    between matches come from a split by the same pattern; their lengths give the places."""
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(pattern), F.lit(parts[-1]))
    both = F.zip_with(match, tested, lambda m, t: F.struct(m.alias("m"), t.alias("t")))
    items = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(match)), both,
                       lambda gap, b: F.struct(F.char_length(gap).alias("gap"),
                                               F.char_length(b["m"]).alias("n"), b["m"].alias("m"),
                                               keep(b["t"]).alias("ok")))
    shape = "array<struct<kind:string,start:int,end:int,match:string>>"

    def placed(items):
        passed = _before(F.transform(items, lambda x: x["gap"] + x["n"]), lambda a, x: a + x)
        every = F.zip_with(items, passed, lambda x, at: F.struct(
            x["ok"].alias("ok"), F.struct(
                F.lit(kind).alias("kind"), (at + x["gap"]).alias("start"),
                (at + x["gap"] + x["n"]).alias("end"), x["m"].alias("match")).alias("span")))
        return F.transform(F.filter(every, lambda x: x["ok"]), lambda x: x["span"]).cast(shape)

    return F.when(text.rlike(pattern), _let(items, placed)).otherwise(F.array().cast(shape))


def _free(found: Column, base: Column) -> Column:
    """The candidates that overlap no base span: base spans by start and candidates by end in one
    order, and before each candidate the furthest end of the base spans that start before its end."""
    row = lambda at, rank, reach, start, match: F.struct(
        at.alias("at"), F.lit(rank).alias("rank"), reach.alias("reach"), start.alias("start"),
        match.alias("match"))
    events = F.array_sort(F.concat(
        F.transform(base, lambda b: row(b["start"], 1, b["end"], b["start"], F.lit(""))),
        F.transform(found, lambda c: row(c["end"], 0, F.lit(0), c["start"], c["match"]))))

    def swept(events):
        reach = _before(F.transform(events, lambda e: e["reach"]),
                        lambda a, x: F.greatest(a, x))
        both = F.zip_with(events, reach, lambda e, r: F.struct(e.alias("e"), r.alias("r")))
        free = F.filter(both, lambda x: (x["e"]["rank"] == 0) & (x["r"] <= x["e"]["start"]))
        return F.transform(free, lambda x: F.struct(
            x["e"]["start"].alias("start"), x["e"]["at"].alias("end"), x["e"]["match"].alias("match")))
    return _let(events, swept)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution: a logistic approximation near the middle, beyond 3.5
    the asymptotic series, which is right to 0.2 % there and better further out."""
    near = 1.0 / (1.0 + F.exp(F.least(F.lit(600.0), 1.5976 * z + 0.07056 * z * z * z)))
    w = 1.0 / (z * z)
    far = F.exp(-0.5 * z * z) / (z * 2.5066282746310002) * (1 - w * (1 - 3 * w * (1 - 5 * w)))
    return F.when(z > 3.5, far).otherwise(near)


def _battery(match: Column) -> Column:
    """``encoding, p`` of one candidate string. Written as nested one-element transforms, so that
    every intermediate value is computed once."""
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, pattern, letters in reversed(ENCODINGS):
        is_it = match.rlike(pattern) if pattern else F.lit(True)
        name = F.when(is_it, F.lit(n)).otherwise(name)
        alphabet = F.when(is_it, F.lit(letters)).otherwise(alphabet)

    def tests(x: Column, k: Column, size: Column) -> Column:
        counts = F.transform(F.array_distinct(x), lambda v: F.size(
            F.filter(x, lambda y: y == v)).cast("double"))
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
        mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / size
        variance = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v) / size - mean * mean
        high = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.when(2 * v >= k, 1.0).otherwise(0.0))
        zero = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("turns"),
                        F.lit(0.0).alias("cross"))
        walk = F.aggregate(x, zero, lambda a, v: F.struct(
            v.alias("last"),
            (a["turns"] + F.when((2 * v >= k) != (2 * a["last"] >= k), 1.0).otherwise(0.0))
            .alias("turns"),
            (a["cross"] + F.coalesce(a["last"] * v, F.lit(0.0))).alias("cross")))
        return _let(F.struct(squares.alias("squares"), mean.alias("mean"),
                            variance.alias("variance"), high.alias("high"), walk.alias("walk"),
                            F.get(x, F.lit(0)).alias("first"), F.get(x, size.cast("int") - 1).alias("end")),
                   lambda s: _let(_scores(s, k, size), lambda z: F.least(
                       F.lit(1.0), 3 * F.least(_tail(z["chi"]), 2 * _tail(F.abs(z["runs"])),
                                               2 * _tail(F.abs(z["serial"]))))))

    def _scores(s: Column, k: Column, size: Column) -> Column:
        free = k - 1
        chi2 = s["squares"] * k / size - size
        chi = (F.cbrt(chi2 / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        expected = 2 * s["high"] * (size - s["high"]) / size + 1
        spread = (expected - 1) * (expected - 2) / (size - 1)
        runs = F.when(spread > 0, (s["walk"]["turns"] + 1 - expected) / F.sqrt(spread)).otherwise(
            F.lit(40.0))
        # sum of (x_i - m)(x_i+1 - m) over the neighbours
        cross = (s["walk"]["cross"] - s["mean"] * (2 * size * s["mean"] - s["first"] - s["end"])
                 + (size - 1) * s["mean"] * s["mean"])
        serial = F.when(s["variance"] > 1e-12,
                        (cross / (size * s["variance"]) + 1 / size) * F.sqrt(size)).otherwise(
            F.lit(40.0))
        return F.struct(chi.alias("chi"), runs.alias("runs"), serial.alias("serial"))

    return _let(F.struct(name.alias("name"), alphabet.alias("alphabet")), lambda e: _let(
        F.transform(F.split(match, ""), lambda c: (F.instr(e["alphabet"], c) - 1).cast("double")),
        lambda x: F.struct(e["name"].alias("encoding"),
                           tests(x, F.char_length(e["alphabet"]).cast("double"),
                                 F.size(x).cast("double")).alias("p"))))


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, candidates``: base spans in order, and the tested candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        F.concat(_spans(F.col("text"), ASSIGN, "assign",
                        lambda v: F.char_length(v) >= MIN_ASSIGN, (0, 2)),
                 _spans(F.col("text"), ACCESS, "access", lambda v: F.char_length(v) >= MIN_ACCESS),
                 _spans(F.col("text"), HEX, "hex", lambda v: F.lit(True))).alias("base"),
        _spans(F.col("text"), CANDIDATE, "random", lambda v: F.lit(True)).alias("found"))
    order = F.array_sort(F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
        .alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    free = _free(F.col("found"), F.col("base"))
    tested = F.transform(free, lambda c: F.struct(c.alias("c"), _battery(c["match"]).alias("test")))
    return df.select("doc_id", order.alias("base"), F.transform(tested, lambda t: F.struct(
        t["c"]["start"].alias("start"), t["c"]["end"].alias("end"),
        t["test"]["encoding"].alias("encoding"), t["test"]["p"].alias("p"))).alias("candidates"))


def _weighted_bin(p: Column, n: Column, mean_length: float) -> Column:
    """Bin of p divided by the weight n / mean_length; higher bins are smaller p."""
    score = -F.log10(F.greatest(p, F.lit(1e-300))) + F.log10(n / F.lit(mean_length))
    return F.greatest(F.lit(0), F.least(F.lit(MAX_BIN), F.floor(score * BINS_PER_DECADE))).cast("int")


def structured_from(scanned: DataFrame, fdr: float = FDR) -> tuple[int, float]:
    """The lowest bin whose candidates are declared structured, and the mean length used."""
    tested = scanned.select(F.inline("candidates"))
    n = (F.col("end") - F.col("start")).cast("double")
    mean = tested.agg(F.avg(n)).first()[0] or 1.0
    counts = dict(tested.groupBy(_weighted_bin(F.col("p"), n, mean).alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())   # MAX_BIN + 1 rows at most
    total, above, lowest = sum(counts.values()), 0, MAX_BIN + 1
    for b in range(MAX_BIN, -1, -1):
        above += counts.get(b, 0)
        if above and total * 10.0 ** (-b / BINS_PER_DECADE) <= fdr * above:
            lowest = b
    return lowest, mean


def scan_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``doc_id, base, random``: spans as ``kind, start, end`` structs in order."""
    scanned = cut(spans(docs), "secrets")
    lowest, mean = structured_from(scanned, fdr)
    left = F.filter("candidates", lambda c: _weighted_bin(
        c["p"], (c["end"] - c["start"]).cast("double"), mean) < lowest)
    plain = lambda s, kind, rank: F.struct(s["start"].alias("start"), rank.alias("rank"),
                                           s["end"].alias("end"), kind.alias("kind"))
    return scanned.select("doc_id", "base", F.transform(left, lambda c: plain(
        c, F.lit("random"), F.lit(len(KINDS)).cast("long"))).alias("random"))


def _joined(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")
                         .select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "random"))).alias("spans"))
