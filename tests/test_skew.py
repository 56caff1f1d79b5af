"""A structure holding a third of all hit rows: split on write, exact on read and aggregate."""

import os

from pyspark.sql import functions as F

from hitroll.operators import scores as S
from hitroll.sinks import files as SK
from hitroll.sources import hits as HF


def test_hot_structure_is_split_and_results_are_whole(spark, tmp_path):
    n = 3000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("s"), (F.col("id") % 97).cast("string"))).alias("c0"),
        F.col("id").cast("string").alias("c1"),
        (F.col("id") % 50).cast("string").alias("c3"),
        F.format_string('{"cath": "c%d"}', (F.col("id") % 4).cast("int")).alias("c15"))
    cols = [F.col(f"c{i}") if f"c{i}" in base.columns else F.lit(None).cast("string").alias(f"c{i}")
            for i in range(16)]
    rows = base.select(*cols, F.lit("ds").alias("dataset"))
    path = str(tmp_path / "hits")
    SK.write_hit_files(rows, path, ["dataset"], key="c0", rows_per_file=200)
    raw = HF.read_hit_files(spark, path, glob="part-*")
    # the hot structure (1,000 rows, 5 salts) went to several tasks, each writing its own file
    hot_files = raw.where("c0 = 'hot'").select("file_name").distinct().count()
    assert hot_files >= 2
    assert len([f for f in os.listdir(os.path.join(path, "dataset=ds")) if f.startswith("part-")]) >= 2
    hits = HF.parse_hits(raw, structure=F.col("c0"))
    per = {r["structure"]: (r["n_hits"], r["mean_score"]) for r in S.per_structure(hits).collect()}
    assert sum(v[0] for v in per.values()) == n
    hot_scores = [i % 50 for i in range(0, n, 3)]
    assert per["hot"] == (len(hot_scores), sum(hot_scores) / len(hot_scores))
    grain = S.code_grain(hits)
    totals = {r["code"]: r["count"] for r in
              S.code_totals(grain.withColumn("dataset", F.lit("ds"))).collect()}
    assert totals == {f"c{k}": n // 4 for k in range(4)}
