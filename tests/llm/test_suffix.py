import hashlib
import random
from collections import Counter

import numpy as np

from hitroll.llm import suffix_dedup as S
from tests.llm.edge import docs_frame, empty_docs, rows_of, save

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "text")


def brute(docs):
    raw = [(i, (t or "").encode()) for i, t in docs]
    times = Counter(b[k:k + 400] for _, b in raw for k in range(len(b) - 399))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 399):
            if times[b[k:k + 400]] > 1:
                gone[k:k + 400] = True
        gone = gone[:len(b)]
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), len(kept),
                    kept.decode("utf-8", "replace")))
    return sorted(out, key=repr)


def test_suffix_array():
    rng = random.Random(15)
    for _ in range(1500):
        top = rng.choice([1, 2, 3, 9])
        s = [rng.randint(1, top) for _ in range(rng.randint(0, 40))] + [0]
        assert S.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_every_window_has_one_anchor():
    rng = random.Random(16)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") if rng.random() < .3 else 97
                       for _ in range(rng.randint(400, 1300))) for _ in range(rng.randint(1, 4))]
        starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
        _, _, low, high, _, _ = S.anchors(np.frombuffer(b"".join(texts), np.uint8), starts)
        owned = Counter(w for a, b in zip(low.tolist(), high.tolist()) for w in range(a, b + 1))
        assert owned == Counter(s + k for s, t in zip(starts.tolist(), texts)
                                for k in range(len(t) - 399))


def corpus(rng, n, passages=6):
    word = lambda: rng.choice("the of and été über a".split()) + str(rng.randint(0, 9))
    shared = [" ".join(word() for _ in range(rng.choice([70, 90, 150, 400]))) for _ in range(passages)]
    docs = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 120))) for _ in range(3)]
        if rng.random() < .6:
            p = rng.choice(shared)
            lo, hi = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            parts.insert(rng.randint(0, 3), p if rng.random() < .5 else p[lo:hi])
        docs.append((i, rng.choice([" ", "\n", "ü"]).join(parts)))
    docs += [(n, None), (n + 1, ""), (n + 2, "ab" * 700), (n + 3, "x" * 399), (n + 4, "y" * 400),
             (n + 5, "z" * 401), (n + 6, docs[3][1]), (n + 7, docs[3][1]), (3, docs[3][1]),
             (n + 8, docs[5][1] + docs[5][1])]
    return docs


def test_against_brute_force(spark, tmp_path):
    docs = corpus(random.Random(17), 60)
    folder = save(docs_frame(spark, docs).repartition(5), tmp_path)
    assert rows_of(S.op4_suffix_array_dedup(spark, folder), *COLUMNS) == brute(docs)


def test_hot_groups_are_dealt_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 3)
    docs = corpus(random.Random(18), 50, passages=1)
    folder = save(docs_frame(spark, docs).repartition(3), tmp_path)
    assert rows_of(S.op4_suffix_array_dedup(spark, folder), *COLUMNS) == brute(docs)


def test_long_texts_in_overlapping_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 1500)
    rng = random.Random(19)
    part = "".join(rng.choice("abcdefg é") for _ in range(2500))
    docs = [(0, part + "".join(rng.choice("hij") for _ in range(3000)) + part[300:2000]),
            (1, "".join(rng.choice("klm") for _ in range(700)) + part[1000:1900])]
    folder = save(docs_frame(spark, docs), tmp_path)
    assert rows_of(S.op4_suffix_array_dedup(spark, folder), *COLUMNS) == brute(docs)


def test_empty_table(spark, tmp_path):
    assert S.op4_suffix_array_dedup(spark, save(empty_docs(spark), tmp_path)).collect() == []
