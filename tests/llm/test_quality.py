import math
import random
import re

from hitroll.llm import quality as Q
from tests.llm.edge import docs_frame, empty_docs, save

WS = "[\\x20\\x09-\\x0D]+"


def counts(text):
    text = text or ""
    words = [w for w in re.split(WS, text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\\x20\\x09-\\x0D]", x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many = {g for g in grams if grams.count(g) > 1}
    covered = {k for i, g in enumerate(grams) if g in many for k in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_base_counts_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    vocabulary = ["a", "bb", "ccc", "é$", "<x>", "dd|"]
    texts = [None, "", " \n\t", "one"]
    for _ in range(40):
        base = [rng.choice(vocabulary[:rng.randint(1, 6)]) for _ in range(rng.randint(1, 90))]
        if rng.random() < .5:
            base += base[:rng.randint(0, len(base))]
        texts.append("".join(w + rng.choice([" ", "\n", "\x0b", " "]) for w in base))
    texts.append("long " * 20000)
    out = Q.op8_quality_rules(spark, save(docs_frame(spark, texts), tmp_path))
    for r in out.collect():
        want = counts(texts[r.doc_id])if r.doc_id < len(texts) - 1 else (20000, 80000, 0, 0, 20000)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_fences_adapt_and_keep_clean_documents(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    clean = [" ".join(word() for _ in range(60)) for _ in range(300)]
    code = [" ".join(word() + "|" for _ in range(60)) for _ in range(300)]
    junk = [" ".join(word() + "$%&*" for _ in range(60)) for _ in range(10)]
    docs = docs_frame(spark, clean + junk, "prose").union(
        docs_frame(spark, [(1000 + k, t) for k, t in enumerate(code)], "code"))
    kept = {r.doc_id for r in Q.filter_quality(docs).collect()}
    assert kept == set(range(300)) | set(range(1000, 1300))
    assert Q.filter_quality(docs).columns == docs.columns


def test_sketches_merge_and_empty_table(spark, tmp_path):
    assert Q.op8_quality_rules(spark, save(empty_docs(spark), tmp_path)).collect() == []
    docs = docs_frame(spark, [f"{'w%d ' % k * 5}" + " ".join(f"x{j}" for j in range(30))
                              for k in range(40)], lambda i: f"s{i % 2}")
    judged = Q.base_counts(docs)
    whole = {(r["rule"], r["bin"]): r["n"] for r in
             Q.sketches(judged).groupBy("rule", "bin").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    parts = {}
    for half in (0, 1):
        for r in Q.sketches(judged.where(f"doc_id % 2 = {half}")).collect():
            parts[r["rule"], r["bin"]] = parts.get((r["rule"], r["bin"]), 0) + r["n"]
    assert whole == parts


def test_fences_follow_size_without_a_switch(spark):
    """A source of short texts with few symbols beside one of many: its fence moves a little with each
    document, from its language's towards its own, and equals the formula at every size."""
    rule = (Q.Rule("symbol_ratio", 0.05),)

    def fence(n):
        rows = [("symbol_ratio", "en", "big", 0, 3000), ("symbol_ratio", "en", "big", 50, 1000),
                ("symbol_ratio", "en", "small", 10, n), ("symbol_ratio", None, "big", 20, 500)]
        df = spark.createDataFrame(rows, "rule string, lang string, source string, bin int, n long")
        return {(r[0], r[1]): r[2] for r in Q.fences(df, rule).collect()}

    def quartile(share, *bins):
        values = sorted(b for b, n in bins for _ in range(n))
        return Q.GAMMA ** values[math.ceil(share * len(values)) - 1]

    def formula(n):
        big, small, other = [(0, 3000), (50, 1000)], [(10, n)], [(20, 500)]
        q = []
        for share in (0.25, 0.75):
            lang, every = quartile(share, *big, *small), quartile(share, *big, *small, *other)
            lang = ((4000 + n) * lang + Q.POOL * every) / (4000 + n + Q.POOL)
            q.append((n * quartile(share, *small) + Q.POOL * lang) / (n + Q.POOL))
        return q[1] + 6.0 * (q[1] - q[0]) + 0.05

    sizes = [1, 49, 199, 200, 201]
    got = [fence(n)["en", "small"] for n in sizes]
    for n, g in zip(sizes, got):
        assert abs(g - formula(n)) < 1e-9, (n, g, formula(n))
    assert abs(got[3] - got[2]) < 0.01 and abs(got[4] - got[3]) < 0.01
    assert (None, "big") in fence(5)
