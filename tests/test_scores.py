"""Aggregates: three-state outcome (R1), macro mean (R2), population std (R3, R4), empty
datasets (R5), Counter semantics (R6), partition independence."""

import math

import pytest
from pyspark.sql import functions as F

from hitroll.operators import scores as S


def _structures(spark, rows):
    return spark.createDataFrame(rows, "structure string, dataset string")


def _hits(spark, rows):
    return spark.createDataFrame(rows, "structure string, score double, code string, bad boolean")


def test_three_outcomes(spark):
    st = _structures(spark, [("a", "d"), ("b", "d"), ("c", "d"), ("e", "d")])
    hits = _hits(spark, [("a", 90.0, "x", False), ("a", 80.0, "y", False),
                         ("e", 70.0, "x", False), ("e", None, None, True)])
    listed = spark.createDataFrame([("a",), ("b",), ("e",)], "structure string")
    out = {r["structure"]: (r["outcome"], r["mean_score"], r["n_hits"])
           for r in S.outcomes(st, S.per_structure(hits), listed).collect()}
    assert out == {"a": ("hits", 85.0, 2), "b": ("zero_hits", 0.0, 0),
                   "c": ("no_output", None, 0), "e": ("rejected", None, 2)}


def test_dataset_statistics_macro_mean_and_pop_std(spark):
    st = _structures(spark, [("a", "d"), ("b", "d"), ("c", "d")])
    hits = _hits(spark, [("a", 1.0, "x", False), ("a", 3.0, "x", False), ("b", 6.0, "x", False)])
    stats = S.dataset_statistics(S.scored(S.outcomes(st, S.per_structure(hits)))).first()
    # per-structure means 2, 6, 0 (c has zero hits) -> mean 8/3, population std
    vals = [2.0, 6.0, 0.0]
    m = sum(vals) / 3
    assert stats["mean_score"] == pytest.approx(m)
    assert stats["std_score"] == pytest.approx(math.sqrt(sum((v - m) ** 2 for v in vals) / 3))
    assert stats["n_structures"] == 3


def test_equal_means_std_is_zero(spark):
    """R4: the reference's formula goes negative here; stddev_pop gives 0.0."""
    st = _structures(spark, [(f"s{i}", "d") for i in range(3)])
    hits = _hits(spark, [(f"s{i}", 98.4244, "x", False) for i in range(3)])
    row = S.dataset_statistics(S.scored(S.outcomes(st, S.per_structure(hits)))).first()
    assert row["std_score"] == 0.0 and row["mean_score"] == pytest.approx(98.4244)


def test_empty_dataset_defaults(spark):
    """R5: a catalogued dataset with nothing scored gets 0.0 / 0.0 / 0."""
    st = _structures(spark, [("a", "d1"), ("b", "d2")])
    hits = _hits(spark, [("a", 5.0, "x", False), ("b", None, None, True)])
    cat = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "dataset string")
    rows = {r["dataset"]: tuple(r)[1:] for r in
            S.dataset_statistics(S.scored(S.outcomes(st, S.per_structure(hits))), cat).collect()}
    assert rows == {"d1": (5.0, 0.0, 1), "d2": (0.0, 0.0, 0), "d3": (0.0, 0.0, 0)}


def test_code_totals_exclude_rejected(spark):
    st = _structures(spark, [("a", "d"), ("b", "d")])
    hits = _hits(spark, [("a", 1.0, "x", False), ("a", 1.0, "x", False), ("a", 1.0, "y", False),
                         ("b", 1.0, "x", False), ("b", None, None, True)])
    got = {(r["code"], r["count"]) for r in S.code_totals(S.code_grain(hits), st).collect()}
    assert got == {("x", 2), ("y", 1)}
    got = {(r["structure"], r["code"], r["n"]) for r in S.code_counts(hits).collect()}
    assert ("a", "x", 2) in got


def test_datasets_that_share_structure_names_stay_apart(spark):
    st = _structures(spark, [("x.pdb", "one"), ("x.pdb", "two"), ("y.pdb", "two")])
    hits = spark.createDataFrame([("one", "x.pdb", 10.0, "a", False), ("two", "x.pdb", 90.0, "b", False),
                                  ("two", "y.pdb", 50.0, "b", False), ("two", "y.pdb", None, None, True)],
                                 "dataset string, structure string, score double, code string, bad boolean")
    listed = st.select("dataset", "structure")
    grain = S.code_grain(hits)
    for per in (S.per_structure(hits), S.per_structure_from_grain(grain)):
        out = S.outcomes(st, per, listed)
        stats = {r["dataset"]: (r["mean_score"], r["n_structures"]) for r in
                 S.dataset_statistics(S.scored(out)).collect()}
        assert stats == {"one": (10.0, 1), "two": (90.0, 1)}
    for universe in (st, None):
        got = {(r["dataset"], r["code"], r["count"]) for r in S.code_totals(grain, universe).collect()}
        assert got == {("one", "a", 1), ("two", "b", 1)}


def test_partition_count_does_not_change_results(spark):
    st = spark.range(200).select(F.col("id").cast("string").alias("structure"),
                                 (F.col("id") % 3).cast("string").alias("dataset"))
    hits = (spark.range(2000).select((F.col("id") % 180).cast("string").alias("structure"),
                                     ((F.col("id") * 7) % 101).cast("double").alias("score"),
                                     (F.col("id") % 5).cast("string").alias("code"),
                                     F.lit(False).alias("bad")))
    base = sorted(S.dataset_statistics(S.scored(S.outcomes(st, S.per_structure(hits)))).collect())
    for n in (1, 7):
        again = sorted(S.dataset_statistics(S.scored(S.outcomes(
            st.repartition(n), S.per_structure(hits.repartition(n))))).collect())
        for a, b in zip(base, again):
            assert a["dataset"] == b["dataset"] and a["n_structures"] == b["n_structures"]
            assert a["mean_score"] == pytest.approx(b["mean_score"])
            assert a["std_score"] == pytest.approx(b["std_score"])


def test_sample_std_single_value_is_zero(spark):
    st = _structures(spark, [("a", "d")])
    hits = _hits(spark, [("a", 4.0, "x", False)])
    row = S.sample_statistics(S.scored(S.outcomes(st, S.per_structure(hits)))).first()
    assert row["std_score"] == 0.0
