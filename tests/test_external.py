"""The command stage: exit codes, output capture, failures, timeouts, output files (UDF2)."""

import os
import sys

from pyspark.sql import functions as F

from hitroll.operators import external as X
from hitroll.sources import hits as HF

SEARCH = r"""
import json, sys
text = open(sys.argv[1]).read()
name = sys.argv[2]
lines = [l for l in text.splitlines() if l.strip()]
if not lines:
    sys.exit(3)
with open(name + "_search.tsv", "w") as fh:
    fh.write("\t".join("h%d" % i for i in range(16)) + "\n")
    for l in lines:
        cells = ["q", "t", "x", str(len(l))] + ["f"] * 11 + [json.dumps({"cath": l.split()[0]})]
        fh.write("\t".join(cells) + "\n")
"""


def test_stdin_command_and_failures(spark):
    df = spark.createDataFrame([("a", "hello"), ("b", "")], "structure string, value string")
    got = {r["structure"]: (r["rc"], r["out"].strip()) for r in
           X.run_command(df, ["wc", "-c"], min_partitions=2).collect()}
    assert got == {"a": (0, "5"), "b": (0, "0")}
    bad = X.run_command(df, ["false"]).collect()
    assert {r["rc"] for r in bad} == {1}
    missing = X.run_command(df, ["/nonexistent/program"]).collect()
    assert {r["rc"] for r in missing} == {-2}
    slow = X.run_command(df.limit(1), ["sleep", "5"], timeout=0.5).collect()
    assert slow[0]["rc"] == -1


def test_output_file_and_hit_parsing(spark, tmp_path):
    script = tmp_path / "search.py"
    script.write_text(SEARCH)
    df = spark.createDataFrame([("s1.pdb", "alpha one\nbeta two\nalpha three\n"), ("s2.pdb", "\n")],
                               "structure string, value string")
    stage = X.run_command(df, [sys.executable, str(script), "{input}", "{name}"],
                          output_file="{name}_search.tsv").cache()
    rows = {r["structure"]: r for r in stage.collect()}
    assert rows["s2.pdb"]["rc"] == 3 and rows["s2.pdb"]["out"] is None   # no output (R1)
    hits = HF.parse_hits(X.hits_from_output(stage.where("out is not null"), ["structure"]),
                         structure=F.col("structure"))
    got = sorted((r["code"], r["score"]) for r in hits.collect())
    assert got == [("alpha", 9.0), ("alpha", 11.0), ("beta", 8.0)]


def test_child_scratch_is_private_and_removed(spark):
    from pyspark import SparkFiles
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "structure string, value string")
    got = {r["structure"]: r["out"].strip() for r in
           X.run_command(df, ["sh", "-c", "pwd"], min_partitions=2).collect()}
    root = os.path.realpath(SparkFiles.getRootDirectory())   # local mode: same JVM as the tasks
    assert got["a"] != got["b"]
    for d in got.values():
        assert os.path.realpath(d).startswith(root + os.sep)
        assert not os.path.exists(d)


def test_tasks_do_not_share_the_parent_of_their_scratch(spark):
    from pyspark import SparkFiles
    df = spark.range(8).selectExpr("cast(id as string) structure", "'x' value").repartition(2)
    script = "ls -A | wc -l; pwd; mkdir -p a/b; echo old > a/b/c; echo old > seg; chmod 500 a/b ."
    got = [r["out"].split() for r in X.run_command(df, ["sh", "-c", script], extra_files=["seg"]).collect()]
    assert {n for n, _ in got} == {"0"} and len({d for _, d in got}) == 8
    parents = {os.path.realpath(os.path.dirname(d)) for _, d in got}
    root = os.path.realpath(SparkFiles.getRootDirectory())
    assert len(parents) == 2 and {os.path.dirname(p) for p in parents} == {root}
    assert not any(os.path.exists(p) for p in parents)


def test_whole_error_output_environment_and_further_files(spark):
    df = spark.createDataFrame([("a", "x")], "structure string, value string")
    script = ("i=0; while [ $i -lt 9000 ]; do echo 0123456789 >&2; i=$((i+1)); done; "
              "echo $EXTRA; echo seg > $0_segment.tsv")
    r = X.run_command(df, ["sh", "-c", script, "{name}"], env={"EXTRA": "given"},
                      extra_files=["{name}_segment.tsv", "{name}_absent.tsv"]).first()
    assert r["out"] == "given\n" and len(r["err"]) == 99000
    assert r["files"] == {"a_segment.tsv": "seg\n"}


def test_partitions_are_a_minimum(spark):
    df = spark.range(40).selectExpr("cast(id as string) structure", "'x' value").repartition(7)
    assert X.run_command(df, ["true"], min_partitions=3).rdd.getNumPartitions() == 7
    assert X.run_command(df, ["true"], min_partitions=9).rdd.getNumPartitions() == 9


def test_output_without_a_header_line_is_no_output(spark):
    df = spark.createDataFrame([("", 1), (None, 2), ("h", 3), ("\n", 4)], "out string, k int")
    assert sorted(r["k"] for r in df.where(X.has_output()).collect()) == [3, 4]


def test_records_keep_quoted_line_ends(spark):
    meta = '"{""cath"": ""1.2""}"'
    rows = ["\t".join(["q", "t", '"two\nlines ""x"" \t tab"', "5"] + ["f"] * 11 + [meta]),
            "", "\t".join(["q", 'a"b', "x", "7"] + ["f"] * 11 + [meta]),
            "\t".join(["q", '"' + "z" * 60000 + '"', "x", "8"] + ["f"] * 11 + [meta])]
    for end in ("\n", "\r\n"):
        text = end.join(["\t".join(f"h{i}" for i in range(16)), *rows])
        df = spark.createDataFrame([("s", text), ("t", text + end)], "structure string, out string")
        hits = HF.parse_hits(X.hits_from_output(df, ["structure"]), structure=F.col("structure"))
        got = sorted((r["structure"], r["score"], r["code"], r["bad"]) for r in hits.collect())
        assert got == [(s, v, "1.2", False) for s in "st" for v in (5.0, 7.0, 8.0)]
        cell = X.hits_from_output(df, ["structure"]).where("structure = 's' and c3 = '5'").first()["c2"]
        assert cell == 'two\nlines "x" \t tab'
