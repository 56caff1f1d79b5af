import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from hitroll.llm import packing as P
from tests.llm.edge import docs_frame, empty_docs, save


def check_bins(rows, capacity):
    """Pieces fill every sequence without gaps from 0 on and within the capacity."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def brute_pieces(docs, tok, capacity):
    out = []
    for i, t in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=repr)


def test_pieces_and_places(spark, tmp_path):
    rng = random.Random(20)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    docs = [(k, " ".join(word() for _ in range(int(rng.expovariate(1 / 300))))) for k in range(150)]
    docs += [(200, None), (201, ""), (202, "word " * 30000), (5, docs[5][1]), (5, docs[5][1]),
             (203, "<|endoftext|> x"), (None, "null id")]
    docs += [(300 + k, "same text") for k in range(100)]
    got = P.op10_best_fit_packing(spark, save(docs_frame(spark, docs), tmp_path)).collect()
    tok = Tokenizer.from_file(P.vocabulary_path(P.VOCABULARY))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got),
                  key=repr) == brute_pieces(docs, tok, 2048)
    bins = check_bins(got, 2048)
    assert bins <= 1.02 * -(-sum(r.length for r in got) // 2048) + 1


def test_very_long_runs_of_white_space():
    vocabulary = P.vocabulary_path(P.VOCABULARY)
    tok, encode = Tokenizer.from_file(vocabulary), P.encoder(vocabulary, P.vocabulary_path(P.RANKS))
    edge = P.LONG_BLANK
    texts = [" " * 2_000_000, "\n" * 2_000_000 + "x", "a" + " \n\t\u3000" * 500_000 + "b", "a" * 2_000_000,
             *("x" + " " * n + "y" for n in (edge - 1, edge, edge + 1, 200_000)), "\x1c" * 20_000]
    for text in texts:
        assert encode(text) == tok.encode(text, add_special_tokens=False).ids


def test_both_libraries_give_the_same_ids():
    vocabulary = P.vocabulary_path(P.VOCABULARY)
    tok, encode = Tokenizer.from_file(vocabulary), P.encoder(vocabulary, P.vocabulary_path(P.RANKS))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}b 1{chr(c)}{chr(c)}2 {chr(c)} {chr(c)}'s  {chr(c)}!\n"
                       for c in points[lo:lo + 4000])
        assert encode(text) == tok.encode(text, add_special_tokens=False).ids
    rng = random.Random(22)
    letters = "aZé1 \n\t'!’\u3000\xa0\x85\u200b日あ한🙂٣½"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        text += rng.choice(["", "<|endoftext|>"]) + text
        assert encode(text) == tok.encode(text, add_special_tokens=False).ids


def test_exact_lengths():
    assert P.piece_bounds(2048, 2048) == [(0, 2048)]
    assert P.piece_bounds(4096, 2048) == [(0, 2048), (2048, 2048)]
    assert P.piece_bounds(2049, 2048) == [(0, 1), (1, 2048)]


def test_plan_is_whole_and_tight():
    rng = random.Random(21)
    for capacity in (7, 30, 100):
        for _ in range(200):
            counts = {rng.randint(1, capacity): rng.randint(1, 60) for _ in range(rng.randint(0, 20))}
            plan = P.plan_bins(counts, capacity)
            packed = {}
            for bins, held in plan:
                assert bins > 0 and sum(n * k for n, k in held) <= capacity
                assert sum(k for n, k in held if 3 * n > capacity) <= 2
                for n, k in held:
                    packed[n] = packed.get(n, 0) + bins * k
            assert packed == counts
            total = sum(n * c for n, c in counts.items())
            used = sum(b for b, _ in plan)
            least = max(-(-total // capacity), sum(c for n, c in counts.items() if 2 * n > capacity))
            assert used <= 1.5 * least + 1


def test_sequences_hold_the_ids(spark):
    docs = docs_frame(spark, ["alpha beta", "gamma", "delta " * 3000])
    tok = Tokenizer.from_file(P.vocabulary_path(P.VOCABULARY))
    ids = [t for s in P.packed_sequences(docs).collect() for t in s.ids]
    assert len(ids) == sum(len(tok.encode(t, add_special_tokens=False).ids) + 1
                           for t in ["alpha beta", "gamma", "delta " * 3000])


def test_empty_table(spark, tmp_path):
    assert P.op10_best_fit_packing(spark, save(empty_docs(spark), tmp_path)).collect() == []
