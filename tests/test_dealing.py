"""Dealing by cost: every task near the even share, keys together, nothing lost."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hitroll.operators.dealing import deal_by_cost, longest_first
from hitroll.operators.external import run_command


def loads(df, n_tasks, cost="cost"):
    got = {r[0]: r[1] for r in df.groupBy(F.spark_partition_id().alias("t")).agg(F.sum(cost)).collect()}
    assert set(got) <= set(range(n_tasks))
    return got


def skewed(kind, n=4000):
    rnd = random.Random(5)
    cost = {"pareto": lambda i: int(10 * rnd.paretovariate(1.1)), "even": lambda i: 7,
            "one_long": lambda i: 40_000 if i == 17 else 10, "few_long": lambda i: 5_000 if i % 400 == 0 else 1,
            "zero": lambda i: 0}[kind]
    return [(f"s{i}", cost(i), "x" * (i % 5)) for i in range(n)]


@pytest.mark.parametrize("kind", ["pareto", "even", "one_long", "few_long", "zero"])
@pytest.mark.parametrize("n_tasks", [1, 6, 13])
def test_largest_task(spark, kind, n_tasks):
    rows = skewed(kind)
    df = spark.createDataFrame(rows, "structure string, cost long, value string").repartition(3)
    dealt = deal_by_cost(df, "cost", n_tasks, ["structure"])
    assert dealt.columns == df.columns and dealt.rdd.getNumPartitions() == n_tasks
    assert Counter(map(tuple, dealt.collect())) == Counter(rows)
    costs = [max(c, 1) for _, c, _ in rows]
    got = loads(dealt.withColumn("cost", F.greatest("cost", F.lit(1))), n_tasks)
    assert max(got.values()) <= sum(costs) / n_tasks * 4 / 3 + max(costs)
    assert len(got) == n_tasks


def test_keys_nulls_names_and_empty(spark):
    rows = [("a", 5), ("a", 5), (None, 3), (None, None), ("b", -4)] * 20
    df = spark.createDataFrame(rows, "`key` string, `_task` long")
    dealt = deal_by_cost(df, F.col("_task"), 4, ["key"])
    assert Counter(map(tuple, dealt.collect())) == Counter(rows)
    homes = dealt.select("key", F.spark_partition_id().alias("t")).distinct().groupBy("key").count()
    assert {r["count"] for r in homes.collect()} == {1}
    empty = deal_by_cost(df.limit(0), "_task", 4, ["key"])
    assert empty.collect() == [] and empty.columns == df.columns
    with pytest.raises(ValueError):
        deal_by_cost(df, "_task", 0, ["key"])


def test_longest_first():
    rnd = random.Random(3)
    for _ in range(200):
        costs = [rnd.choice([1, 2, 3, 50, 400]) for _ in range(rnd.randint(0, 40))]
        m = rnd.randint(1, 7)
        tasks = longest_first(costs, m)
        sums = [sum(c for c, t in zip(costs, tasks) if t == k) for k in range(m)]
        assert max(sums) <= sum(costs) / m + max(costs, default=0) * (1 - 1 / m) + 1e-9


def test_command_dealt_by_cost(spark):
    rows = [(f"s{i}", "x" * (5000 if i % 50 == 0 else 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "structure string, value string")
    out = run_command(df, ["wc", "-c"], min_partitions=4, cost=F.length("value"))
    got = out.select("structure", F.trim("out").cast("int").alias("n"), F.spark_partition_id().alias("t")).collect()
    assert {(r["structure"], r["n"]) for r in got} == {(s, len(v)) for s, v in rows}
    assert Counter(r["t"] for r in got if r["n"] == 5000) == {t: 1 for t in range(4)}
