import random
import re
from collections import Counter

from hitroll.llm import collocations as C
from tests.llm.edge import docs_frame, empty_docs


def pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def brute(rows, least, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(p, q) for q, b in candidates.items()):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def rows_of(spark, rows):
    docs = docs_frame(spark, [t for _, t in rows])
    from pyspark.sql import functions as F
    langs = spark.createDataFrame(list(enumerate(l for l, _ in rows)), "doc_id long, l string")
    return docs.join(langs, "doc_id").withColumn("lang", F.col("l"))


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(rng, n):
    words = ["the", "of", "New", "York", "city", "é", "日本", "a-b", "x'y", "%s", " z", "\x1cq", "\x00n", "of_a"]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for _ in range(n):
        ws = rng.choices(words, weights, k=rng.randint(0, 40))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r", "\x0b", "; "]) for w in ws)
        if rng.random() < .3:
            text += "in new york city hall. "
        out.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return out


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    rows = corpus(rng, 250) + [("en", None), ("en", ""), ("fr", "  "), ("en", "rare words here"),
                               ("en", "over and over again " * 5000), ("de", "x" * 300_000)]
    rows += rows[:20]
    docs = rows_of(spark, rows)
    for least, top in ((8, 2000), (30, 7)):
        want = brute(rows, least, top)
        assert len(want) > 5
        assert got(C.collocations(docs, least, top)) == want
    # However windows, slices and the filter are cut: small ones cost rows, not results.
    monkeypatch.setattr(C, "WINDOW_BYTES", 3000)
    monkeypatch.setattr(C, "HELD_PHRASES", 60)
    monkeypatch.setattr(C, "SLICES", 3)
    monkeypatch.setattr(C, "MIN_FILTER_BITS", 1 << 12)
    monkeypatch.setattr(C, "MAX_FILTER_BITS", 1 << 12)
    assert got(C.collocations(docs, 8, 2000)) == brute(rows, 8, 2000)


def test_the_filter_has_no_false_negatives(spark, monkeypatch):
    import numpy as np
    phrases = [("en", f"w{i} w{i * 7 % 13}") for i in range(3000)]
    df = spark.createDataFrame(phrases, "lang string, phrase string").repartition(3)
    hashes = C._phrase_hashes([a.encode() for a, _ in phrases], [b.encode() for _, b in phrases])
    others = C._phrase_hashes([b"en"] * 3000, [f"v{i} u".encode() for i in range(3000)])
    held = C.phrase_filter(df)
    assert C._in_filter(hashes, held).all() and C._in_filter(others, held).mean() < 0.05
    monkeypatch.setattr(C, "MIN_FILTER_BITS", 1 << 12)
    monkeypatch.setattr(C, "MAX_FILTER_BITS", 1 << 12)
    small = C.phrase_filter(df)
    assert len(small) == 512 and C._in_filter(hashes, small).all() and np.unpackbits(small).any()


def test_scores_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    score = spark.sql(f"SELECT cast((cast(2000000 as decimal(10,0)) * cast({a}L as decimal(20,0))) div "
                      f"(cast({a}L as decimal(20,0)) + cast({a + 5}L as decimal(20,0))) as long) AS s").first().s
    assert score == 2_000_000 * a // (2 * a + 5)


def test_empty_tables(spark):
    assert C.collocations(empty_docs(spark)).collect() == []
    assert C.collocations(docs_frame(spark, [None, "", "one two"])).collect() == []
