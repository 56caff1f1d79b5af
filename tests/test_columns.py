"""Per-row rules: score parsing (R18), JSON code extraction (R9, R21), structure ids (R16)."""

import math

import pytest
from pyspark.sql import functions as F

from hitroll.functions.columns import (basename, percent_difference, py_float, structure_id,
                                       with_json_check)

SCORES = [("90", 90.0), (" 5.5 ", 5.5), ("1_0", 10.0), ("1__0", None), ("_1", None),
          ("90d", None), ("0x10", None), ("1e3", 1000.0), ("-.5", -0.5), ("1.", 1.0),
          ("inf", math.inf), ("-Infinity", -math.inf), ("nan", "nan"), ("NaN", "nan"),
          ("", None), ("abc", None)]


def test_py_float_matches_python(spark):
    df = spark.createDataFrame([(s,) for s, _ in SCORES], "s string")
    got = dict((r[0], r[1]) for r in df.select("s", py_float("s")).collect())
    for s, want in SCORES:
        try:
            py = float(s)
        except ValueError:
            py = None
        if want == "nan":
            assert math.isnan(got[s]) and math.isnan(py)
        else:
            assert got[s] == want == py, s


JSON = [('{"cath": "2.60.40.10"}', "2.60.40.10", None),
        ('{"cath": null}', "None", None),
        ('{"cath": "a,b"}', "a,b", None),
        ('{"cath": 5}', "5", None),
        ('{"cath": true}', "True", None),
        ('{"cath": 1.50}', "1.5", None),
        ("{", None, "bad_json"),
        ("{}", None, "missing_key"),
        ("[1]", None, "bad_json"),
        ("{'cath': 'a'}", None, "bad_json"),
        ('{"cath": {"q": 1}}', None, "nested_value"),
        ('{"cath": [1]}', None, "nested_value"),
        ('{"other": 1}', None, "missing_key"),
        ('{"cath": NaN}', "nan", None),
        ('{"cath":"a","cath":"b"}', "b", None),
        ('{"cath":"a"} x', None, "bad_json")]


def test_json_check(spark):
    df = spark.createDataFrame([(j,) for j, _, _ in JSON], "j string")
    staged = {r[0]: (r[1], r[2]) for r in
              with_json_check(df, "j", code_col="c", reason_col="r").select("j", "c", "r").collect()}
    for j, c, why in JSON:
        assert staged[j] == (c, why), j


@pytest.mark.parametrize("name,want", [("AF-P1-F1-model_v4.pdb_search.tsv", "AF-P1-F1-model_v4.pdb"),
                                       ("sample_search.tsv", "sample"),
                                       ("x.tsv", "x.tsv")])
def test_structure_id(spark, name, want):
    got = spark.range(1).select(structure_id(F.lit(name))).first()[0]
    assert got == want


def test_basename(spark):
    got = spark.range(1).select(basename(F.lit("hdfs://nn/a/b/c.pdb"))).first()[0]
    assert got == "c.pdb"


def test_percent_difference(spark):
    df = spark.createDataFrame([(2.0, 3.0), (4.0, 1.0), (0.0, 1.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(percent_difference("a", "b")).collect()] == [50.0, -75.0, None, None]
