"""Every stage of the pipeline against a brute-force version, on its own input."""

import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from hitroll.llm import packing as P
from tests.llm.edge import docs_frame, empty_docs
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_packing import brute_pieces, check_bins
from tests.llm.test_quality import counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        out.append(C.cut(stage(spark, out[-1], SF), "test-stage"))
    return [(d.columns, d.collect()) for d in out]


def test_stages_keep_the_columns_of_documents(chain):
    for columns, _ in chain[:-1]:
        assert columns == chain[0][0]


def test_quality_rules(chain):
    before, after = chain[0][1], {r.doc_id for r in chain[1][1]}
    failed = set()
    for r in before:
        n, _, symbols, _, repeat = counts(r.text)
        if n < 20 or 100 * repeat > 30 * n:
            failed.add(r.doc_id)
        elif not symbols and not repeat and len(set(re.findall(r"\S+", r.text))) > n / 3:
            assert r.doc_id in after, r.text[:200]          # clean documents stay
    assert not failed & after and len(after) > 0.75 * len(before)


def test_line_dedup(chain):
    import hashlib
    want = {d: h for d, _, _, h in brute_lines([(r.doc_id, r.text) for r in chain[1][1]])}
    assert len(chain[2][1]) == len(chain[1][1])
    for r in chain[2][1]:
        assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id]
        assert r.n_chars == len(r.text)


def test_near_duplicates(chain):
    rows = sorted(chain[2][1], key=lambda r: r.doc_id)
    groups = brute_groups([r.text for r in rows], 5, 80)
    want = sorted(rows[i].doc_id for i, _, root in groups if i == root)
    assert sorted(r.doc_id for r in chain[3][1]) == want


def test_mixing(chain):
    before = {r.doc_id: r for r in chain[3][1]}
    times = Counter(r.doc_id for r in chain[4][1])
    assert set(times) == set(before) and set(times.values()) <= {1, 2}
    for r in chain[4][1]:
        assert r == before[r.doc_id]


def test_packing(chain):
    tok = Tokenizer.from_file(P.vocabulary_path(P.VOCABULARY))
    got = chain[5][1]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got),
                  key=repr) == brute_pieces([(r.doc_id, r.text) for r in chain[4][1]], tok, 2048)
    check_bins(got, 2048)


def test_run_is_the_chain_of_stages(spark, chain):
    run = C.run(spark, SF)
    assert run.columns == chain[5][0]
    key = lambda r: (r.doc_id, r.piece, r.ids_crc32)
    assert sorted(map(key, run.collect())) == sorted(map(key, chain[5][1]))


def test_edge_rows_pass_through(spark):
    line = "a line of more than forty characters that very many documents share"
    rows = [(k, f"{line}\n" + " ".join(f"{k}w{j}" for j in range(30))) for k in range(8)]
    rows += [(20, None), (21, ""), (3, rows[3][1]), (None, " ".join(f"x{j}" for j in range(30))),
             (22, " ".join(f"y{j % 5000}" for j in range(40000)))]
    for docs in (docs_frame(spark, rows), empty_docs(spark)):
        for k, (_, stage) in enumerate(C.STAGES):
            out = C.cut(stage(spark, docs, SF), "edge-stage")
            assert k == 4 or out.columns == docs.columns
            docs = out
        docs.collect()
