"""Container bundle: standard tools read it, the index finds every entry, failed jobs leave nothing."""

import os
import subprocess
import tarfile

import pytest
from pyspark.sql import functions as F

from hitroll.sinks import bundle
from hitroll.sinks.bundle import read_bundle, write_bundle

SCHEMA = "dataset string, file_name string, content binary"


def rows_of(n=300):
    rows = [(f"d{i % 3}", f"s{i} é.pdb_segment.tsv", os.urandom(i * 37 % 9000)) for i in range(n)]
    return [*rows, ("d0", "none", None), ("d1", "x" * 180, b"long name"), ("d2", "big", os.urandom(3 << 20))]


def read_back(spark, path):
    return {f"{r[0]}/{r[1]}": bytes(r[2]) for r in read_bundle(spark, path).collect()}


@pytest.mark.parametrize("parts", [1, 5])
def test_round_trip_and_standard_tools(spark, tmp_path, parts):
    rows, path = rows_of(), str(tmp_path / "out" / "all.tar.gz")
    write_bundle(spark.createDataFrame(rows, SCHEMA).repartition(parts), path)
    want = {f"{d}/{n}": c or b"" for d, n, c in rows}
    with tarfile.open(path) as t:
        assert {m.name: t.extractfile(m).read() for m in t.getmembers()} == want
    subprocess.run(["gzip", "-t", path], check=True)
    listed = subprocess.run(["tar", "tzf", path, "--quoting-style=literal"], check=True, capture_output=True)
    assert set(listed.stdout.decode().splitlines()) == set(want)
    assert read_back(spark, path) == want
    assert sorted(os.listdir(tmp_path / "out")) == ["all.tar.gz", "all.tar.gz.index"]


def test_members_are_cut(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b.tar.gz")
    rows = [("d", f"s{i}", os.urandom(300_000)) for i in range(12)]
    write_bundle(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    assert spark.read.parquet(path + ".index").select("member").distinct().count() == 3
    assert read_back(spark, path) == {f"d/{n}": c for _, n, c in rows}


def test_replaced_and_empty(spark, tmp_path):
    path = str(tmp_path / "b.tar.gz")
    df = spark.createDataFrame([("d", "a", b"1")], SCHEMA)
    write_bundle(df, path)
    write_bundle(spark.createDataFrame([("d", "b", b"22")], SCHEMA), f"file:{path}")
    assert read_back(spark, path) == {"d/b": b"22"}
    write_bundle(df.limit(0), path)
    with tarfile.open(path) as t:
        assert t.getmembers() == []
    assert read_back(spark, path) == {}


def test_an_index_of_another_run(spark, tmp_path):
    path = str(tmp_path / "b.tar.gz")
    write_bundle(spark.createDataFrame([("d", "a", b"1")], SCHEMA), path)
    with open(path, "ab") as f:
        f.write(b"more")
    with pytest.raises(Exception, match="another bundle"):
        read_bundle(spark, path).collect()


@pytest.mark.parametrize("bad", [("d", "a/b"), ("d", ".."), ("d", None), (None, "x"), ("d", "s7")])
def test_a_failed_job_leaves_what_was(spark, tmp_path, bad):
    path = str(tmp_path / "b.tar.gz")
    write_bundle(spark.createDataFrame([("d", "old", b"1")], SCHEMA), path)
    rows = [("d", f"s{i}", b"x") for i in range(30)]
    with pytest.raises(Exception):
        write_bundle(spark.createDataFrame([*rows, (*bad, b"bad")], SCHEMA).repartition(4), path)
    assert read_back(spark, path) == {"d/old": b"1"}
    assert sorted(os.listdir(tmp_path)) == ["b.tar.gz", "b.tar.gz.index"]


def test_text_and_other_columns(spark, tmp_path):
    path = str(tmp_path / "b.tar.gz")
    df = spark.range(50).select("id", F.lit("set").alias("dataset"), F.concat(F.lit("n"), "id").alias("file_name"),
                                F.concat(F.lit("é"), "id").alias("content"))
    write_bundle(df, path)
    assert read_back(spark, path) == {f"set/n{i}": f"é{i}".encode() for i in range(50)}
    assert bundle.MEMBER == 1 << 20
