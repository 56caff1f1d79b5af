"""Two formulations of the benchmark reduction (PT5, AG12, AG13, AG14, SC13).

Input: rows ``(float_value, count_dict)`` (see ``sources.tables.lineitem_maps``). Output: mean and
sample standard deviation of ``float_value`` and the total per key of ``count_dict``.

* :func:`dataframe_formulation` is the plan this library uses: one aggregate job and one
  explode + grouped sum, both with partial aggregation on the executors.
* :func:`rdd_formulation` is the row-object baseline: moments per partition merged in a tree, and
  the map entries reduced by key on the executors.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitroll.functions.columns import percent_difference
from hitroll.operators.maps import entries

# Fractions of the rows at which the two formulations are compared.
FRACTIONS = (0.01, 0.1, 1.0)


def dataframe_formulation(rows: DataFrame) -> tuple[dict, dict]:
    st = rows.select(F.count(F.lit(1)).alias("n"), F.avg("float_value").alias("mean"),
                     F.coalesce(F.stddev_samp("float_value"), F.lit(0.0)).alias("std_dev")).first()
    totals = (entries(rows, "count_dict", "id", "count")
              .groupBy("id").agg(F.sum("count").alias("total_count")))
    return st.asDict(), {r["id"]: r["total_count"] for r in totals.collect()}


def _moments(rows):
    """Count, mean and sum of squared distances from the mean of one partition."""
    values = [float(r[0]) for r in rows]
    if values:
        mean = math.fsum(values) / len(values)
        yield len(values), mean, math.fsum((v - mean) ** 2 for v in values)


def _merged(a, b):
    n = a[0] + b[0]
    step = b[1] - a[1]
    return n, a[1] + step * b[0] / n, a[2] + b[2] + step * step * a[0] * b[0] / n


def rdd_formulation(rows: DataFrame) -> tuple[dict, dict]:
    data = rows.select("float_value", "count_dict").rdd
    parts = data.mapPartitions(_moments)
    n, mean, spread = parts.treeReduce(_merged) if not parts.isEmpty() else (0, None, 0.0)
    totals = data.flatMap(lambda r: (r[1] or {}).items()).reduceByKey(lambda x, y: x + y)
    std = math.sqrt(spread / (n - 1)) if n > 1 else 0.0
    return {"n": n, "mean": mean, "std_dev": std}, dict(totals.collect())


def compare(rows: DataFrame) -> dict:
    """Time both formulations on the same rows and check that they agree."""
    t0 = time.perf_counter()
    st_df, c_df = dataframe_formulation(rows)
    t1 = time.perf_counter()
    st_rdd, c_rdd = rdd_formulation(rows)
    t2 = time.perf_counter()
    agree = c_df == c_rdd and st_df["n"] == st_rdd["n"] and (st_df["n"] == 0 or (
        math.isclose(st_df["mean"], st_rdd["mean"], rel_tol=1e-9)
        and math.isclose(st_df["std_dev"], st_rdd["std_dev"], rel_tol=1e-6, abs_tol=1e-9)))
    spark = rows.sparkSession
    diff = spark.range(1).select(percent_difference(F.lit(t1 - t0), F.lit(t2 - t1))).first()[0]
    return {"rows": st_df["n"], "dataframe_sec": t1 - t0, "rdd_sec": t2 - t1,
            "difference_pct": diff, "agree": agree}


def sweep(rows: DataFrame, fractions=FRACTIONS) -> list[dict]:
    """PT5: both formulations timed on the same rows at several sizes, each cached once."""
    out = []
    for f in fractions:
        part = (rows if f >= 1 else rows.sample(False, f, seed=7)).cache()
        part.count()
        out.append(compare(part))
        part.unpersist()
    return out
