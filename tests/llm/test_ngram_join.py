import random
import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa

from hitroll.llm import ngram_join as N
from hitroll.llm import shingles as SH
from hitroll.llm.components import components
from tests.llm.edge import docs_frame, empty_docs, rows_of, save

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = [w for w in re.split("[\\x20\\x09-\\x0D]+", (text or "").translate(LOWER)) if w]
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def roots(n, edges):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def brute(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    edges = [(a, b) for a, b in combinations(range(len(sets)), 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sorted(((i, len(sets[i]), r) for i, r in enumerate(roots(len(sets), edges))), key=repr)


def corpus(rng, n=120):
    word = lambda: rng.choice("the of and a b c d é Ü".split()) + str(rng.randint(0, 400))
    passage = [word() for _ in range(60)]
    bases = [[word() for _ in range(rng.randint(1, 160))] for _ in range(12)]
    texts = [None, "", " \t\n", "one", "ONE", "two words", "Two  Words", "three of words"]
    while len(texts) < n:
        w = list(rng.choice(bases)) if rng.random() < .7 else [word() for _ in range(100)]
        if rng.random() < .3:
            at = rng.randint(0, len(w))
            w[at:at] = passage
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = word()
        texts.append("".join(x + rng.choice([" ", "  ", "\n", "\x0b"]) for x in w))
    return texts


def test_against_brute_force(spark, tmp_path):
    texts = corpus(random.Random(6))
    folder = save(docs_frame(spark, texts).repartition(5), tmp_path)
    columns = ("doc_id", "n_shingles", "component_id")
    assert rows_of(N.op5_ngram_jaccard(spark, folder), *columns) == brute(texts, 3, 90)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert rows_of(N.near_duplicates(docs), *columns) == brute(texts, 5, 80)


def test_chain_of_near_copies_is_one_component(spark):
    rng = random.Random(7)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    texts = []
    for k in range(60):                       # each differs from the one before by one word
        words = list(words)
        words[(k * 37) % 200] = f"n{k}"
        texts.append(" ".join(words))
    got = rows_of(N.near_duplicates(docs_frame(spark, texts), 3, 90),
                  "doc_id", "n_shingles", "component_id")
    assert got == brute(texts, 3, 90)


def below_threshold(rng, n, changed):
    """Copies of one text that mostly lie just below the threshold to one another."""
    base, texts = [f"w{rng.randint(0, 10**6)}" for _ in range(220)], []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(1, changed)):
            words[rng.randrange(len(words))] = f"n{k}.{rng.randint(0, 9)}"
        texts.append(" ".join(words))
    return texts


def test_large_groups_below_the_threshold(spark, monkeypatch):
    rng = random.Random(11)
    texts = below_threshold(rng, 150, 12) + below_threshold(rng, 60, 5) + ["other text " * 30]
    docs = docs_frame(spark, texts)
    want = brute(texts, 5, 80)
    assert 3 < len({r[2] for r in want}) < len(texts) - 50
    calls = []
    plain = N._block_pairs
    monkeypatch.setattr(N, "_block_pairs", lambda *a: calls.append(1) or plain(*a))
    columns = ("doc_id", "n_shingles", "component_id")
    for star, short, chunk, tokens in ((2, 32, 256, 1 << 13), (0, 3, 16, 40), (0, 1 << 20, 16, 40)):
        for name, value in (("STAR_ROUNDS", star), ("SHORT_LIST", short), ("CHUNK_NODES", chunk),
                            ("BLOCK_TOKENS", tokens), ("TILE_NODES", max(chunk // 3, 1))):
            monkeypatch.setattr(N, name, value)
        assert rows_of(N.near_duplicates(docs, 5, 80), *columns) == want
    assert calls


def test_repeated_rows_empty_table_and_one_of_each(spark, tmp_path):
    assert N.op5_ngram_jaccard(spark, save(empty_docs(spark), tmp_path)).collect() == []
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    docs = docs_frame(spark, [(3, a), (3, a), (5, a + " x"), (4, b), (None, b), (8, ""), (9, None)])
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 8, 9]


def test_prefix_condition_never_misses(spark):
    """Pairs at the threshold share ``match`` shingles in the prefixes, for every m."""
    rng = np.random.default_rng(8)
    for _ in range(300):
        n, percent = int(rng.integers(5, 80)), int(rng.choice([80, 90]))
        x = rng.choice(10**6, n, replace=False)
        y = x.copy()
        change = rng.integers(0, n // 5 + 1)
        y[rng.choice(n, change, replace=False)] = rng.integers(10**6, 2 * 10**6, change)
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if 100 * both < percent * (len(x) + len(y) - both):
            continue
        for m in range(1, 9):
            nx, ny = -(-percent * len(x) // 100), -(-percent * len(y) // 100)
            if m <= min(nx, ny):
                assert len(np.intersect1d(x[:len(x) - nx + m], y[:len(y) - ny + m])) >= m


def test_words_across_chunks(monkeypatch):
    rng = random.Random(9)
    texts = ["".join(rng.choice("aB é\n\t") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    texts += [None, "x" * 500, " " * 100 + "y", "z"]
    column = pa.array(texts).slice(1)

    def all_words():
        return [w.tolist() for _, w in SH.documents(column, SH.WordHasher())]
    whole = all_words()
    for size in (7, 64, 1000):
        monkeypatch.setattr(SH, "CHUNK", size)
        assert all_words() == whole
    words = [re.split("[\\x20\\x09-\\x0D]+", (t or "").translate(LOWER)) for t in texts[1:]]
    assert [len(w) for w in whole] == [len([x for x in w if x]) for w in words]
    seen = {}
    for w, hs in zip(words, whole):
        for x, h in zip([x for x in w if x], hs):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rng = random.Random(10)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(400 + k, 401 + k) for k in range(50)] + [(500, 501 + k) for k in range(50)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = roots(600, edges)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {v: want[v] for e in edges for v in e if e[0] != e[1]}


def test_near_copies_of_very_long_texts(spark):
    words = [f"w{k}" for k in range(420_000)]        # 90 * 90 * n is beyond 32 bits
    other = list(words)
    for at in range(0, len(words), 1000):
        other[at] = "x" + other[at]
    docs = docs_frame(spark, [" ".join(words), " ".join(other), "some other text"])
    for k, percent in ((3, 90), (5, 80)):
        got = rows_of(N.near_duplicates(docs, k, percent), "doc_id", "n_shingles", "component_id")
        n = len(words) - k + 1
        assert got == [(0, n, 0), (1, n, 0), (2, 1, 2)]


def test_one_of_each_keeps_different_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(50)) for x in "abc")
    docs = docs_frame(spark, [(3, a), (3, b), (3, a + " x"), (5, b + " y"), (5, c), (6, c), (6, " "),
                              (6, None), (7, a)])
    kept = sorted((r.doc_id, (r.text or "").strip()[:1]) for r in N.one_of_each(docs).collect())
    assert kept == [(3, "a"), (3, "b"), (5, "c"), (6, "")]


def test_tiles_hold_every_pair_once(monkeypatch):
    monkeypatch.setattr(N, "TILE_NODES", 3)
    for sizes in ((7,), (7, 5), (3, 3), (1, 8), (2,)):
        rows = pd.DataFrame([(k * 10 + j, k) for k, n in enumerate(sizes) for j in range(n)],
                            columns=["node", "chunk"]).sample(frac=1, random_state=1)
        across, met = len(sizes) == 2, []
        for apart, tile in N._tiles(rows, across):
            assert len(tile) <= 6 and tile["node"].is_monotonic_increasing
            named = list(zip(tile["node"], tile["chunk"]))
            met += [(a, b) for i, (a, x) in enumerate(named) for b, y in named[i + 1:]
                    if not apart or x != y]
        chunk = dict(zip(rows["node"], rows["chunk"]))
        want = [(a, b) for a in chunk for b in chunk if a < b
                and (not across or chunk[a] != chunk[b])]
        assert sorted(met) == sorted(want)
    assert list(N._tiles(pd.DataFrame({"node": [1, 2], "chunk": [0, 0]}), True)) == []
