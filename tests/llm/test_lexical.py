import math
import random
import re
from collections import Counter

from hitroll.llm import lexical_search as L
from tests.llm.edge import docs_frame, empty_docs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, k):
    bags = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    nn, ll = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for (doc, bag), n in zip(bags, sizes):
            m = 75 + 25 * n * nn // ll if ll else 0
            score = sum(math.floor(1000 * math.log((2 * nn + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
                        for t in words(text) if bag[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, run string, score int")


def got(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünder", "STRASSE", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 60))) for _ in range(n)]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=12)), "x", 1) for i in range(40)]
    return texts, items


def test_ranks_against_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    texts, items = corpus(rng, 400)
    texts += texts[:30] + [None, "", " . ", "a" * 200_000, "w5 " * 30_000, "w1,w2;W3_w4"]
    texts += [items[3][1]] * 25 + [items[4][1] + " more"]
    items += [(100, None, "x", 1), (101, "", "x", 1), (102, "nowhere at all", "x", 1), (3, items[3][1].upper(), "x", 1),
              (None, "w7 w8", "x", 1)]
    pairs = list(enumerate(texts))
    docs, asked = docs_frame(spark, texts), frame(spark, items)
    plain = [(i if i is not None else -1, t) for i, t, *_ in items]
    want = brute(pairs, plain, 20)
    norm = lambda rows: sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows)
    assert norm(L.search(docs, asked).select("item_id", "rank", "doc_id", "score").collect()) == want
    # However runs, bundles and blocks are cut.
    monkeypatch.setattr(L, "RUN_DOCS", 7)
    monkeypatch.setattr(L, "BUNDLE_ITEMS", 9)
    monkeypatch.setattr(L, "BLOCK_BYTES", 1500)
    assert norm(L.search(docs, asked).select("item_id", "rank", "doc_id", "score").collect()) == want


def test_documents_leave_only_when_they_cannot_return(spark, monkeypatch):
    """Few results asked for: most accumulators are dropped early, ties at the edge stay."""
    rng = random.Random(2)
    texts, items = corpus(rng, 300)
    texts += [items[k][1] for k in range(10) for _ in range(3)]
    monkeypatch.setattr(L, "RUN_DOCS", 40)
    for k in (1, 2, 5):
        assert got(L.search(docs_frame(spark, texts), frame(spark, items), k)) == brute(
            list(enumerate(texts)), [i[:2] for i in items], k)


def test_rows_without_id_and_repeated_ids(spark):
    rows = [(None, "w1 w2 w3"), (1, "w1"), (1, "w1 w2"), (2, "w3 w4"), (3, "w9 w9"), (4, "w4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(0, "w1 w2 w9", "x", 1)]
    assert got(L.search(docs, frame(spark, items))) == brute(rows, [(0, "w1 w2 w9")], 20)


def test_empty_tables(spark):
    docs, asked = docs_frame(spark, ["w1"]), frame(spark, [(0, "w1", "x", 1)])
    assert L.search(empty_docs(spark), asked).collect() == []
    assert L.search(docs, asked.limit(0)).collect() == []
    assert L.search(docs_frame(spark, [None, ""]), asked).collect() == []
    assert L.search(docs, frame(spark, [(0, "...", "x", 1)])).columns == ["item_id", "rank", "doc_id", "score"]
