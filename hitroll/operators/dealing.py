"""Dealing records to tasks by cost (PT1): longest first, from a histogram.

Hash placement evens out the number of records, not their cost: one task can get several of the long
ones. Here every key is placed by its cost. Keys that cost at least a ``1/grain`` of a task's even
share are units of their own (there are at most ``grain * n_tasks`` of them, by their definition);
all cheaper keys fall by hash into as many cells, whose cost is measured. The units, longest first,
go to the task with the least so far. No task then exceeds the even share by more than one unit: one
key, or one cell of cheap keys, about a ``grain``-th of a share.

The histogram has at most ``2 * grain * n_tasks`` rows whatever the number of records; only it passes
the driver. Records move twice at most (the join with the placement broadcasts it up to
``BROADCAST_UNITS`` rows, 24 bytes each, and shuffles beyond). The cost is read in a pass of its own,
so it should be a cheap column (the file's length, not its text). Costs and placement depend on
content alone, so a task that is run again takes the same records.

A key's rows stay together: a key that repeats is one unit, as long as all its rows. Null keys are a
key. A null or negative cost counts as 0, and every record costs at least 1, so that records without
cost are spread too. Empty tables come back empty in ``n_tasks`` partitions.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAIN = 16
BROADCAST_UNITS = 1_000_000


def longest_first(costs: Sequence[int], n_tasks: int) -> list[int]:
    """The task of each unit: units by falling cost (ties by place), each to the least loaded task."""
    loads = [(0, t) for t in range(n_tasks)]
    tasks = [0] * len(costs)
    for i in sorted(range(len(costs)), key=lambda i: (-costs[i], i)):
        load, t = loads[0]
        tasks[i] = t
        heapq.heapreplace(loads, (load + costs[i], t))
    return tasks


def deal_by_cost(df: DataFrame, cost: Column | str, n_tasks: int, keys: Sequence[str],
                 grain: int = GRAIN) -> DataFrame:
    """``df`` in ``n_tasks`` partitions of about equal summed ``cost``; columns as they were."""
    if n_tasks < 1 or grain < 1:
        raise ValueError("n_tasks and grain must be positive")
    cost = F.col(cost) if isinstance(cost, str) else cost
    each = F.greatest(F.coalesce(cost.cast("bigint"), F.lit(0)), F.lit(1)).cast("bigint")
    cells = grain * n_tasks
    narrow = df.select(F.xxhash64(*keys).alias("key"), each.alias("cost"))
    by_key = narrow.groupBy("key").agg(F.sum("cost").alias("cost"))
    total = narrow.agg(F.sum("cost")).first()[0] or 0
    least = max(1, -(-total // cells))                       # cost from which a key is a unit
    unit = F.when(F.col("cost") >= least, F.col("key")).otherwise(F.pmod("key", F.lit(cells)))
    histogram = (by_key.select((F.col("cost") >= least).alias("alone"), unit.alias("unit"), "cost")
                 .groupBy("alone", "unit").agg(F.sum("cost").alias("cost")))
    units = sorted(map(tuple, histogram.collect()))          # at most 2 * cells rows
    tasks = longest_first([c for _, _, c in units], n_tasks)
    return _placed(df, keys, units, tasks, n_tasks, cells)


def _placed(df, keys, units, tasks, n_tasks, cells):
    spark, out = df.sparkSession, df.columns
    place = {(alone, u): t for (alone, u, _), t in zip(units, tasks)}
    alone = [(u, t) for (a, u), t in place.items() if a]
    cell = [(u, t) for (a, u), t in place.items() if not a]
    # Names that no column of the records has.
    key, own, shared, task = (f"_{n}_{len(max(out, key=len))}{'_' * len(max(out, key=len))}"
                              for n in ("key", "own", "shared", "task"))
    df = df.withColumn(key, F.xxhash64(*keys)).withColumn(shared, F.pmod(key, F.lit(cells)))

    def joined(df, rows, on, name):
        small = spark.createDataFrame(rows, f"`{on}` bigint, `{name}` int")
        return df.join(F.broadcast(small) if len(rows) <= BROADCAST_UNITS else small, on, "left")

    df = joined(joined(df, alone, key, own), cell, shared, task)
    return df.repartitionById(n_tasks, F.coalesce(own, task)).select(*out)
