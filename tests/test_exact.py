"""Exact means: equal to the rational mean, bit for bit, however the rows are dealt."""

import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from hitroll.operators.exact import exact_mean, exact_per_structure, exact_sums, merge_sums
from hitroll.operators.scores import per_structure

TINY, HUGE = 5e-324, 1.7976931348623157e308


def groups():
    rnd = random.Random(7)
    out = {
        "tenths": [0.1] * 10, "cancel": [1e308, 1.0, -1e308], "one": [math.pi], "zeros": [0.0, -0.0],
        "subnormal": [TINY, 3 * TINY, 2 * TINY], "tiny_tie": [TINY, 0.0], "tiny_up": [TINY, TINY, TINY, 0.0],
        "vanish": [TINY] + [0.0] * 9, "huge": [HUGE] * 7, "negative": [-0.1, -0.2, -0.4, 0.05],
        "span": [HUGE, TINY, -1.0, 2.0 ** -1000], "tie": [1.0, 1.0 + 2 ** -52], "tie_odd": [1.0 + 2 ** -52, 1.0 + 2 ** -51],
        "powers": [2.0 ** i for i in range(-60, 60, 7)], "minus_cancel": [-1e16, 1.0, 1.0, 1e16, -3.0],
        "below_two": [2.0 - 2 ** -52, 2.0, 2.0 - 2 ** -52, 2.0],
    }
    for i in range(40):
        spread = rnd.choice([1, 10, 300])
        out[f"r{i}"] = [rnd.uniform(-1, 1) * 10.0 ** rnd.uniform(-spread, spread) for _ in range(rnd.randint(1, 60))]
    for i in range(40):
        out[f"p{i}"] = [round(rnd.uniform(0, 100), 2) for _ in range(rnd.randint(1, 200))]
    return out


def nearest(xs):
    return float(sum(map(Fraction, xs)) / len(xs))


def result(df):
    return {r["k"]: r for r in exact_mean(exact_sums(df, ["k"], "v"), ["k"]).collect()}


@pytest.mark.parametrize("parts", [1, 7])
def test_equal_to_the_rational_mean(spark, parts):
    want = groups()
    rows = [(k, x) for k, xs in want.items() for x in xs]
    random.Random(parts).shuffle(rows)
    got = result(spark.createDataFrame(rows, "k string, v double").repartition(parts))
    assert set(got) == set(want)
    for k, xs in want.items():
        mean = nearest(xs)
        assert got[k]["n"] == len(xs) and got[k]["mean"] == mean, k
        assert statistics.mean(xs) == got[k]["mean"]
        assert Fraction(got[k]["mantissa"]) * Fraction(2) ** got[k]["exponent"] == Fraction(mean), k
        assert abs(got[k]["mantissa"]).bit_length() == 53 or abs(mean) < 2.3e-308


def test_states_merge(spark):
    want = groups()
    rows = [(k, x) for k, xs in want.items() for x in xs]
    a, b = (spark.createDataFrame(rows[i::2], "k string, v double") for i in (0, 1))
    merged = merge_sums(exact_sums(a, ["k"], "v"), exact_sums(b, ["k"], "v"), ["k"])
    assert {r["k"]: r["mean"] for r in exact_mean(merged, ["k"]).collect()} == {k: nearest(x) for k, x in want.items()}


def test_nulls_and_non_finite(spark):
    inf, nan = math.inf, math.nan
    rows = [("nan", nan), ("nan", 1.0), ("up", inf), ("up", -2.0), ("down", -inf), ("both", inf), ("both", -inf),
            ("null", None), ("some", None), ("some", 3.0), (None, 4.0)]
    got = result(spark.createDataFrame(rows, "k string, v double"))
    assert math.isnan(got["nan"]["mean"]) and math.isnan(got["both"]["mean"])
    assert got["up"]["mean"] == inf and got["down"]["mean"] == -inf and got["up"]["mantissa"] is None
    assert got["null"]["mean"] is None and got["null"]["n"] == 0 and got["null"]["mantissa"] is None
    assert (got["some"]["n"], got["some"]["mean"], got[None]["mean"]) == (1, 3.0, 4.0)
    assert result(spark.createDataFrame([], "k string, v double")) == {}


def test_stands_in_for_the_double_mean(spark):
    rows = [("s1", 0.1, False)] * 10 + [("s2", 50.5, False), ("s2", None, True)]
    hits = spark.createDataFrame(rows, "structure string, score double, bad boolean")
    exact, plain = exact_per_structure(hits), per_structure(hits)
    assert exact.columns == plain.columns
    got = {r["structure"]: r for r in exact.collect()}
    assert got["s1"]["mean_score"] == 0.1 and got["s1"]["n_hits"] == 10 and not got["s1"]["rejected"]
    assert got["s2"]["rejected"] and got["s2"]["n_hits"] == 2


def test_only_native_expressions_and_partial_sums(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("v"))
    plan = exact_mean(exact_sums(df, ["k"], "v"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "partial_sum" in plan
