import math
from collections import Counter

from hitroll.llm import mixing as M
from tests.llm.edge import docs_frame, empty_docs, save

SIZES = {"a": 400, "b": 100, "c": 40, "d": 10}


def documents(spark):
    rows, of = [], {}
    for name, n in SIZES.items():
        for _ in range(n):
            of[len(rows)] = name
            rows.append("w " * (5 + len(rows) % 7))
    return docs_frame(spark, rows, lambda i: of[i])


def shares(sized):
    total = Counter()
    for r in sized.collect():
        total[r.source] += r.tokens
    return {s: t / sum(total.values()) for s, t in total.items()}, total


def entropy(q, a):
    z = sum(x ** a for x in q.values())
    return -sum(x ** a / z * math.log(x ** a / z) for x in q.values())


def test_exponent_meets_repetition_limit_and_entropy(spark):
    sized = M.sized_docs(documents(spark))
    q, _ = shares(sized)
    totals = M.source_totals(sized)
    for limit in (1.0, 1.5, 2.0, 4.0, 100.0):
        a = M.find_exponent(totals, max_epochs=limit)
        want = max(0.0, 1 - math.log(limit) / math.log(max(q.values()) / min(q.values())))
        assert abs(a - want) < 1e-6
    target = entropy(q, 0.6)
    assert abs(M.find_exponent(totals, target_entropy=target, max_epochs=1e9) - 0.6) < 1e-5


def test_realised_epochs_follow_the_weights(spark):
    docs = documents(spark)
    sized = M.sized_docs(docs)
    q, total = shares(sized)
    plan = {r.source: r for r in M.mixing_plan(sized, max_epochs=3.0).collect()}
    made = M.mix(sized, M.mixing_plan(sized, max_epochs=3.0)).collect()
    tokens, longest = Counter(), 11
    copies = Counter()
    for r in made:
        tokens[r.source] += r.tokens
        copies[r.doc_id] += 1
    for s in SIZES:
        want = plan[s].epochs * total[s]
        assert want - longest <= tokens[s] <= want + 1e-6, s
    assert min(copies.values()) >= 1 and len(copies) == sum(SIZES.values())
    assert max(copies.values()) - min(copies.values()) <= 2
    assert abs(sum(r.weight for r in plan.values()) - 1) < 1e-9
    assert min(r.epochs for r in plan.values()) == 1.0
    for s in SIZES:      # whole epochs differ by one at most within a source
        own = [copies[r.doc_id] for r in sized.where(sized.source == s).collect()]
        assert max(own) - min(own) <= 1


def test_budget_and_repeatability(spark):
    sized = M.sized_docs(documents(spark))
    _, total = shares(sized)
    plan = M.mixing_plan(sized, max_epochs=4.0, budget=0.5)
    first = sorted((r.doc_id, r.__getitem__("__epoch")) for r in M.mix(sized, plan).collect())
    again = sorted((r.doc_id, r.__getitem__("__epoch")) for r in M.mix(
        sized.repartition(7), M.mixing_plan(sized.repartition(3), max_epochs=4.0, budget=0.5)).collect())
    assert first == again
    used = sum(r.tokens for r in M.mix(sized, plan).collect())
    assert 0.5 * sum(total.values()) - 4 * 11 <= used <= 0.5 * sum(total.values()) + 1e-6


def test_edge_rows(spark, tmp_path):
    assert M.op2_source_mixing(spark, save(empty_docs(spark), tmp_path)).collect() == []
    docs = docs_frame(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (7, "d " * 9999)],
                      lambda i: None if i == 2 else "s")
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 3, 7]
