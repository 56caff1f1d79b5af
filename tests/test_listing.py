"""Whole-file sources over folders listed by tasks: the rows of Spark's own sources, without a task or
a status on the driver for every few files."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from hitroll.sources import files as FS
from hitroll.sources import listing as LS
from hitroll.streaming import ingest as IN

NAMES = ["a b.txt", "p%41.txt", "é[1].txt", "q#?.txt", "d e.txt", "n .txt", "+;=@&$,.txt", "_h.txt", ".h.txt",
         "{x}|^`\"<>.txt", "plain.tsv"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rows_are_those_of_sparks_sources(spark, tmp_path):
    top = tmp_path / "x y"
    (top / "sub").mkdir(parents=True)
    for n in NAMES:
        (top / n).write_bytes(b"text \xff" + n.encode())
    (top / "zero.txt").write_text("")
    (top / "sub" / "below.txt").write_text("not read")
    with gzip.open(top / "z.txt.gz", "wb") as f:
        f.write(b"one\n")
    with open(top / "z.txt.gz", "ab") as f:
        f.write(gzip.compress(b"two\n"))
    for glob in (None, "*.{txt,gz}", "[a-p]*.txt"):
        r = spark.read.format("text").option("wholetext", True)
        b = spark.read.format("binaryFile")
        if glob:
            r, b = r.option("pathGlobFilter", glob), b.option("pathGlobFilter", glob)
        want = r.load(str(top)).select("_metadata.file_path", "_metadata.file_name", F.hex("value"))
        assert rows(FS.read_texts(spark, str(top), glob).select("path", "file_name", F.hex("value"))) == rows(want)
        want = b.load(str(top)).select("path", "length", "content")
        assert rows(FS.read_binary(spark, str(top), glob).select("path", "length", "content")) == rows(want)


def test_partition_columns_are_those_of_spark(spark, tmp_path):
    for kind in ("1", "a%2Fb", "__HIVE_DEFAULT_PARTITION__"):
        for n in ("007", "12"):
            at = tmp_path / f"kind={kind}" / f"n={n}"
            at.mkdir(parents=True)
            (at / "t.txt").write_text(kind + n)
    want = spark.read.format("text").option("wholetext", True).load(str(tmp_path))
    got = FS.read_texts(spark, str(tmp_path)).select(*want.columns)
    assert got.schema == want.schema and rows(got) == rows(want) and len(rows(got)) == 6


@pytest.fixture
def many(spark, tmp_path):
    """300 files in three folders; scans that Spark cuts would have a task for each."""
    for i in range(300):
        at = tmp_path / "many" / f"folder={i % 3}"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"{i}.txt").write_text(f"{i}\n")
        with gzip.open(at / f"{i}.txt.gz", "wt") as f:
            f.write(f"{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    yield str(tmp_path / "many")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_no_tasks_of_their_own(spark, many):
    """F5, F8, F9."""
    for df in (FS.read_texts(spark, many, "*.txt"), FS.read_texts(spark, many, "*.txt.gz"),
               FS.read_binary(spark, many, "*.txt").withColumn("value", F.decode("content", "UTF-8"))):
        assert df.rdd.getNumPartitions() <= 8
        assert {r["value"]: r["folder"] for r in df.collect()} == {f"{i}\n": i % 3 for i in range(300)}


def test_ingest_cuts_no_task_per_file(spark, many, tmp_path):
    """neither the stream's scan nor its table grows a part per few files."""
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    for _ in range(2):
        IN.ingest_texts(spark, many, table, checkpoint, "value string, folder int", glob="*.txt", run_tag=1)
    got = spark.read.parquet(table)
    assert sorted(r["value"] for r in got.collect()) == sorted(f"{i}\n" for i in range(300))
    assert len([n for n in os.listdir(table) if n.startswith("part-")]) <= 8


def test_ingest_goes_on_after_a_dead_run(spark, tmp_path, monkeypatch):
    src, table, checkpoint = tmp_path / "s", str(tmp_path / "t"), str(tmp_path / "c")
    src.mkdir()
    (src / "a b.txt").write_text("a")
    IN.ingest_texts(spark, str(src), table, checkpoint, run_tag=1)
    (src / "b.txt").write_text("b")

    def dies(*a, **k):
        raise KeyboardInterrupt
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(LS, "contents", dies)          # the arrival is listed, not ingested
        IN.ingest_texts(spark, str(src), table, checkpoint, run_tag=2)
    (src / "c.txt").write_text("c")
    IN.ingest_texts(spark, str(src), table, checkpoint, run_tag=3, max_files_per_trigger=1)
    assert rows(spark.read.parquet(table).select("value", "run")) == [("a", 1), ("b", 3), ("c", 3)]


def test_ingest_goes_on_with_an_older_checkpoint(spark, tmp_path, monkeypatch):
    src, table, checkpoint = tmp_path / "s", str(tmp_path / "t"), str(tmp_path / "c")
    src.mkdir()
    (src / "a.txt").write_text("a")
    with monkeypatch.context() as m:             # a stream of the files themselves
        m.setattr(LS, "find", lambda *a, **k: None)
        IN.ingest_texts(spark, str(src), table, checkpoint, run_tag=1)
    (src / "b.txt").write_text("b")
    IN.ingest_texts(spark, str(src), table, checkpoint, run_tag=2)
    assert rows(spark.read.parquet(table).select("value", "run")) == [("a", 1), ("b", 2)]
