import hashlib
import random
import re
from collections import defaultdict

from hitroll.llm import line_dedup as L
from tests.llm.edge import docs_frame, empty_docs, rows_of, save

STRIP = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    holders = defaultdict(list)
    for row, (doc, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            key = STRIP.sub("", line).translate(LOWER)
            if len(key) >= 40:
                holders[key].append((row, doc))
    gone = {k: max(d for _, d in v) for k, v in holders.items() if len({r for r, _ in v}) >= 5}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines
                if gone.get(STRIP.sub("", x).translate(LOWER), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_lines", "n_dropped", "kept_sha256")


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    common = ["The quick brown fox jumps over the LAZY dog, says É %d" % k for k in range(6)]
    docs = []
    for i in range(60):
        lines = [rng.choice(common) if rng.random() < .4 else "".join(
            rng.choice("abc é") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(0, 8))]
        lines = [rng.choice(["", " ", "\t"]) + x.replace("É", rng.choice("Éé")) + "\r" * (i % 2)
                 for x in lines]
        docs.append((i, "\n".join(x.upper() if rng.random() < .2 and "é" not in x else x
                                  for x in lines)))
    docs += [(60, None), (61, ""), (62, "x\n" * 3000 + common[0]), (7, docs[7][1]), (7, docs[7][1])]
    got = rows_of(L.op1_line_dedup(spark, save(docs_frame(spark, docs), tmp_path)), *COLUMNS)
    assert got == brute(docs)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert L.op1_line_dedup(spark, save(empty_docs(spark), tmp_path)).collect() == []
    line = "a line of more than forty characters, certainly so"
    docs = docs_frame(spark, [line + "\nown %d" % k for k in range(6)])
    kept = L.without_common_lines(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert rows[5].text == line + "\nown 5" and rows[0].text == "own 0"
    assert rows[0].n_chars == 5 and rows[0]["__lines"] == 1 and rows[0]["__id"] == "y"


def test_batches_go_through_levels(spark):
    store = L.LineRuns(spark, fan_in=2, buckets=2)
    for b in range(5):
        docs = docs_frame(spark, [(10 * b + k, f"{'shared line ' * 5}\n{b} own line {'x' * 40}")
                                  for k in range(2)])
        store.add(L.line_rows(docs))
    assert [len(x) for x in store.levels] == [1, 0, 1]
    totals = sorted((r.n_docs, r.max_doc) for r in store.totals().collect())
    assert totals == [(2, 1), (2, 11), (2, 21), (2, 31), (2, 41), (10, 41)]
