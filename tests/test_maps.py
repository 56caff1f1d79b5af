"""Map operators, with the golden example of the notebook."""

import pytest
from pyspark.sql import functions as F

from hitroll.operators import maps as M


def test_golden_combine_pair(spark):
    df = spark.createDataFrame(
        [({"3.40.710.10": 1}, 98.4244, {"3.40.710.10": 3, "2.30.810.20": 2}, 88.4244)],
        "a map<string,bigint>, ma double, b map<string,bigint>, mb double")
    codes, mid = M.combine_pair("a", "ma", "b", "mb")
    r = df.select(codes.alias("c"), mid.alias("m")).first()
    assert dict(r["c"]) == {"3.40.710.10": 4, "2.30.810.20": 2}
    assert r["m"] == pytest.approx(93.4244)


def test_merge_equals_row_merge(spark):
    rows = [({"x": 1, "y": 2}, {"y": 3, "z": 4}), ({}, {"x": 5}), (None, {"q": 1}), ({"w": 2}, None)]
    df = spark.createDataFrame(rows, "a map<string,bigint>, b map<string,bigint>")
    merged = [dict(r[0]) for r in df.select(M.merge_maps("a", "b")).collect()]
    assert merged == [{"x": 1, "y": 5, "z": 4}, {"x": 5}, {"q": 1}, {"w": 2}]
    keys = [sorted(r[0]) for r in df.select(M.key_union("a", "b")).collect()]
    assert keys == [["x", "y", "z"], ["x"], ["q"], ["w"]]


def test_explode_sum_and_counter_semantics(spark):
    df = spark.createDataFrame([({"x": 1, "y": 2},), ({"x": 3, "y": -2},), ({},), (None,)],
                               "codes map<string,bigint>")
    got = {r["code"]: r["total_count"] for r in M.explode_sum(df).collect()}
    assert got == {"x": 4}   # y totals 0 and is dropped, as Counter addition does (R6)


def test_structure_maps_and_get(spark):
    counts = spark.createDataFrame([("s", "x", 2), ("s", "y", 1), ("t", "x", 5)],
                                   "structure string, code string, n bigint")
    m = M.structure_maps(counts)
    got = {r["structure"]: dict(r["codes"]) for r in m.collect()}
    assert got == {"s": {"x": 2, "y": 1}, "t": {"x": 5}}
    assert m.where("structure = 't'").select(M.get_or_zero("codes", "y")).first()[0] == 0


def test_entries_skip_empty_and_null_maps(spark):
    df = spark.createDataFrame([(1, {"x": 2, "y": 3}), (2, {}), (3, None)], "k int, m map<string,int>")
    got = sorted(tuple(r) for r in M.entries(df, "m", keep=["k"]).collect())
    assert got == [(1, "x", 2), (1, "y", 3)]


def test_micro_benchmark_formulations_agree(spark):
    from hitroll.plans.benchmark import compare
    from hitroll.sources.tables import lineitem_maps
    rows = lineitem_maps(spark, "/root/testdata/sf0.001")
    res = compare(rows)
    assert res["rows"] == rows.count() and res["agree"]
    empty = compare(rows.limit(0))
    assert empty["rows"] == 0 and empty["agree"]
    equal = spark.createDataFrame([(98.4244, {"a": 1})] * 3, "float_value double, count_dict map<string,int>")
    assert compare(equal)["agree"]


def test_micro_benchmark_sweep_sizes(spark):
    from hitroll.plans.benchmark import sweep
    from hitroll.sources.tables import lineitem_maps
    rows = lineitem_maps(spark, "/root/testdata/sf0.001")
    res = sweep(rows, fractions=(0.5, 1.0))
    assert 0 < res[0]["rows"] < res[1]["rows"] == rows.count() and all(r["agree"] for r in res)
