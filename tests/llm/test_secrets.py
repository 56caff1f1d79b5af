import hashlib
import math
import random
import re

from hitroll.llm import secret_scan as S
from tests.llm.edge import docs_frame, empty_docs, save

ASSIGN = re.compile(r'''((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', re.A)


def base(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text)
              if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


def test_base_spans_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    bits = ["token", "secret=", "PassWord: ", "api_key", "apikey='", "=", ": ", "AKIA", "ABCDEFGH12345678",
            "deadbeef", "0123456789abcdef", "é", "🙂", " ", "\n", "abc", "abcdef", "\"", "secret", "x", ".",
            "token=secret:abcdefg", "AKIAX"]
    texts = [None, "", "secret=token: abcdefgh", "AKIA" + "Z" * 16, "AKIA" + "Z" * 15, "a" * 24, "a" * 23,
             "token=" + "y" * 30000]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts += texts[8:12]
    got = S.op3_secret_scan(spark, save(docs_frame(spark, texts), tmp_path)).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == want


def test_random_strings_are_found_among_structured_ones(spark):
    rng = random.Random(5)
    b62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    keys = ["".join(rng.choice(b62) for _ in range(rng.choice([32, 40, 64]))) for _ in range(60)]
    syllables = ["the", "ing", "ea", "tion", "er", "on", "re", "st"]
    plain = ["".join(rng.choice(syllables) for _ in range(14)) for _ in range(300)] + ["-" * 40, "_" * 30]
    texts = [f"here is {k} in a text" for k in keys] + [f"word {p} in a text" for p in plain]
    found = S.scan_secrets(docs_frame(spark, texts)).collect()
    hit = {r.doc_id for r in found if r["random"]}
    assert len(hit & set(range(60))) >= 57
    assert len(hit - set(range(60))) <= 3
    for r in found:
        for s in r["random"]:
            assert s["kind"] == "random" and s["end"] - s["start"] >= 20


def test_normal_tails(spark):
    zs = [k / 10 for k in range(-40, 250)]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in df.select("z", S._tail(df["z"]).alias("p")).collect():
        want = math.erfc(r.z / math.sqrt(2)) / 2
        assert abs(r.p - want) < (0.003 * want if r.z > 3.5 else 2e-4)


def test_empty_table(spark, tmp_path):
    assert S.op3_secret_scan(spark, save(empty_docs(spark), tmp_path)).collect() == []


def test_very_many_spans_in_one_text(spark):
    """More spans than a block of the scan, of every kind, in one text."""
    rng = random.Random(6)
    b62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    bits = ["secret=" + "q" * 30, "AKIA" + "B" * 20, "0123456789abcdef" * 2, "word", "é🙂",
            "".join(rng.choice(b62) for _ in range(40)), "token: abc.def.ghi-" + "k" * 25]
    text = " ".join(rng.choice(bits) for _ in range(20_000))
    row = S.spans(docs_frame(spark, [text, "plain"])).orderBy("doc_id").collect()
    assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in row[0]["base"]] == base(text)
    covered = bytearray(len(text))
    for s in row[0]["base"]:
        covered[s["start"]:s["end"]] = b"\1" * (s["end"] - s["start"])
    want = [(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text)
            if not any(covered[m.start():m.end()])]
    assert want and [(c["start"], c["end"]) for c in row[0]["candidates"]] == want
    assert row[1]["base"] == [] and row[1]["candidates"] == []
