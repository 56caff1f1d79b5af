"""Artefacts under their own names: exact names read back, failed jobs leave nothing."""

import os

import pytest
from pyspark.sql import functions as F

from hitroll.sinks.named import write_named_artefacts

SCHEMA = "dataset string, file_name string, content string"


def tree(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read()
            for d, _, files in os.walk(folder) for f in files}


def test_names_and_bytes(spark, tmp_path):
    rows = [(f"d{i % 3}", f"s{i} é.pdb_segment.tsv", f"text {i}\n" * i) for i in range(40)] + [("d0", "none", None)]
    out = str(tmp_path / "out")
    df = spark.createDataFrame(rows, SCHEMA)
    write_named_artefacts(df.repartition(5), out)
    assert tree(out) == {f"{d}/{n}": (c or "").encode() for d, n, c in rows}
    # A later job adds files and replaces those of the same name.
    write_named_artefacts(spark.createDataFrame([("d0", "none", "some"), ("d9", "new", "x")], SCHEMA), f"file:{out}")
    assert len(tree(out)) == 42 and tree(out)["d0/none"] == b"some"
    write_named_artefacts(df.limit(0), out)
    assert len(tree(out)) == 42
    binary = spark.createDataFrame([("b", "raw", bytearray(b"\xff\x00"))], "dataset string, file_name string, content binary")
    write_named_artefacts(binary, out)
    assert tree(out)["b/raw"] == b"\xff\x00"


@pytest.mark.parametrize("bad", [("d", "a/b"), ("d", ".."), ("d", None), ("d", ""), (None, "x"), ("d", "s7"), ("..", "x")])
def test_a_failed_job_leaves_nothing(spark, tmp_path, bad):
    out = tmp_path / "out"
    rows = [("d", f"s{i}", "x") for i in range(30)]
    write_named_artefacts(spark.createDataFrame([("d", "s1", "old")], SCHEMA), str(out))
    df = spark.createDataFrame([*rows, (*bad, "bad")], SCHEMA).repartition(4)
    with pytest.raises(Exception):
        write_named_artefacts(df, str(out))
    assert tree(out) == {"d/s1": b"old"} and os.listdir(out) == ["d"]


def test_a_task_that_fails_late(spark, tmp_path):
    out = tmp_path / "out"
    df = spark.range(0, 1000, 1, 4).select(
        F.lit("d").alias("dataset"), F.col("id").cast("string").alias("file_name"),
        F.when(F.col("id") < 990, "x").otherwise(F.raise_error(F.lit("late"))).alias("content"))
    with pytest.raises(Exception, match="late"):
        write_named_artefacts(df, str(out))
    assert tree(out) == {}


def test_names_are_not_held_by_the_commit(spark, tmp_path):
    """the check for names that repeat across tasks holds 16 bytes a file; the dictionary of names
    and paths that it replaces took some 500."""
    import tracemalloc

    from hitroll.sinks import named
    from hitroll.sources import files as FS
    folders = [(str(t), "d") for t in range(40)]
    listed = lambda at: [f"{at}-{i:06d}.pdb_segment.tsv" for i in range(1000)]
    tracemalloc.start()
    assert named.repeated(folders, listed) is None
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 * 40_000
    assert named.repeated([*folders, ("7", "e")], listed) is None
    assert named.repeated([*folders, ("7", "d")], listed).startswith("d/7-")
    assert named.repeated([], listed) is None
    rows = [(f"d{i % 3}", f"s{i}.tsv", f"text {i}") for i in range(200)]
    write_named_artefacts(spark.createDataFrame(rows, SCHEMA).repartition(5), str(tmp_path / "out"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    found = FS.read_binary(spark, f"{tmp_path}/out/*", glob="*.tsv")
    assert found.rdd.getNumPartitions() <= 8             # not a task per file
    got = {(r["path"].split("/")[-2], r["file_name"], bytes(r["content"]).decode()) for r in found.collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == set(rows)
