"""Writers: single named CSV with overwrite (SNK1, R17), parsed-summary round trip (SNK4, SRC7)."""

import os

from pyspark.sql import functions as F

from hitroll.sinks import files as SK
from hitroll.sources import files as FS


def test_single_csv_overwrites(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    p = SK.write_single_csv(df, folder, "t")
    assert p.endswith("/t.csv")
    SK.write_single_csv(spark.createDataFrame([("b", 2)], "k string, v int"), folder, "t")
    with open(os.path.join(folder, "t.csv")) as fh:
        assert fh.read().splitlines() == ["k,v", "b,2"]
    assert sorted(os.listdir(folder)) == [".t.csv.crc", "t.csv"] or "t.csv" in os.listdir(folder)


def test_parsed_summary_round_trip(spark, tmp_path):
    per = spark.createDataFrame([("s1", 3, 25.5), ("s2", 0, None)],
                                "structure string, n_hits bigint, mean_score double")
    counts = spark.createDataFrame([("s1", "a,b", 2), ("s1", "x", 1)],
                                   "structure string, code string, n bigint")
    text = SK.parsed_summary_text(per, counts)
    lines = {r["structure"]: r["value"] for r in text.collect()}
    assert lines["s1"] == "#s1 Results. mean plddt: 25.5\ncath_id,count\na,b,2\nx,1"
    assert lines["s2"] == "#s2 Results. mean plddt: 0\ncath_id,count"
    SK.write_parsed_summaries(text, str(tmp_path / "p"))
    back = FS.parse_parsed_summary(FS.read_texts(spark, str(tmp_path / "p")), file_col="structure")
    got = {r["structure"]: (r["mean_score"], [tuple(e) for e in r["entries"]]) for r in back.collect()}
    assert got == {"s1": (25.5, [("a,b", 2), ("x", 1)]), "s2": (0.0, [])}


def test_ids_that_look_like_numbers_survive(spark, tmp_path):
    per = spark.createDataFrame([("d1", "007", 1, 2.0), ("d1", "1e2", 1, 3.0), ("007", "x", 1, 4.0)],
                                "dataset string, structure string, n_hits bigint, mean_score double")
    counts = spark.createDataFrame([("d1", "007", "c", 1)],
                                   "dataset string, structure string, code string, n bigint")
    SK.write_parsed_summaries(SK.parsed_summary_text(per, counts), str(tmp_path / "p"))
    back = FS.parse_parsed_summary(FS.read_texts(spark, str(tmp_path / "p")), file_col="structure")
    assert {r["structure"]: len(r["entries"]) for r in back.collect()} == {"007": 1, "1e2": 0, "x": 0}
    docs = spark.createDataFrame([("007", "t\nu"), ("1e2", "")], "doc string, text string")
    SK.write_structure_texts(docs, str(tmp_path / "s"), "doc", "text")
    texts = FS.read_texts(spark, str(tmp_path / "s"))
    assert sorted(r["value"] for r in texts.collect()) == ["007\nt\nu\n", "1e2\n\n"]
    assert texts.select("file_name").distinct().count() == 2


def test_parse_summary_rules(spark):
    texts = spark.createDataFrame([("f", "#f Results. mean plddt: 1_0\ncath_id,count\n\nq,3\nq,4\n"),
                                   ("g", "no marker here\n")], "file_name string, value string")
    rows = {r["file_name"]: r for r in FS.parse_parsed_summary(texts)
            .select("file_name", "mean_score", FS.entries_to_map(F.col("entries")).alias("m"))
            .collect()}
    assert rows["f"]["mean_score"] == 10.0 and dict(rows["f"]["m"]) == {"q": 4}   # last wins
    assert rows["g"]["mean_score"] == 0.0 and dict(rows["g"]["m"]) == {}


def test_csv_dir_gzip_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    SK.write_csv_dir(df, str(tmp_path / "plain"))
    SK.write_csv_dir(df, str(tmp_path / "gz"), compression="gzip")
    assert any(n.endswith(".csv.gz") for n in os.listdir(tmp_path / "gz"))
    for sub in ("plain", "gz"):
        back = spark.read.schema("k string, v int").option("header", True).csv(str(tmp_path / sub))
        assert sorted(tuple(r) for r in back.collect()) == [("a", 1), ("b", 2)]


def test_streaming_ingest_reads_gzip_once(spark, tmp_path):
    import gzip

    from hitroll.streaming.ingest import ingest_texts
    src = tmp_path / "src"
    src.mkdir()
    with gzip.open(src / "a.pdb.gz", "wt") as fh:
        fh.write("one\n")
    table, ckpt = str(tmp_path / "t"), str(tmp_path / "c")
    ingest_texts(spark, str(src), table, ckpt, glob="*.gz", run_tag=1)
    (src / "b.pdb").write_text("two\n")            # not matched by the glob
    with gzip.open(src / "c.pdb.gz", "wt") as fh:
        fh.write("three\n")
    ingest_texts(spark, str(src), table, ckpt, glob="*.gz", run_tag=2)
    got = sorted((r["file_name"], r["value"], r["run"]) for r in spark.read.parquet(table).collect())
    assert got == [("a.pdb.gz", "one\n", 1), ("c.pdb.gz", "three\n", 2)]


def test_late_files_of_any_date_are_ingested(spark, tmp_path):
    from hitroll.streaming.ingest import ingest_texts
    src = tmp_path / "src"
    src.mkdir()
    (src / "new.pdb").write_text("new\n")
    table, ckpt = str(tmp_path / "t"), str(tmp_path / "c")
    ingest_texts(spark, str(src), table, ckpt, run_tag=1)
    (src / "old.pdb").write_text("old\n")
    month_ago = (src / "new.pdb").stat().st_mtime - 30 * 86400
    os.utime(src / "old.pdb", (month_ago, month_ago))
    (src / "empty.pdb").write_text("")
    ingest_texts(spark, str(src), table, ckpt, run_tag=2)
    got = sorted((r["file_name"], r["run"]) for r in spark.read.parquet(table).collect())
    assert got == [("new.pdb", 1), ("old.pdb", 2)]


def test_equal_rows_are_spread(spark, tmp_path):
    cols = [F.lit("same").alias(f"c{i}") for i in range(16)]
    rows = spark.range(4000).select(*cols, F.lit("ds").alias("dataset"))
    SK.write_hit_files(rows, str(tmp_path / "h"), ["dataset"], key="c0", rows_per_file=200)
    files = [n for n in os.listdir(tmp_path / "h" / "dataset=ds") if n.startswith("part-")]
    assert len(files) > 5
    back = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "h"))
    assert back.count() == 4000


def test_one_text_each_moves_whole_folders(spark, tmp_path):
    """No task shares a folder with another one or an earlier job, so the job commit renames folders;
    no checksum file per text, which costs a process each."""
    out = tmp_path / "s"
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc int, text string")
    folders = []
    for part, mode in ((docs.where("doc < 40"), "append"), (docs.where("doc >= 40"), "append")):
        SK.write_structure_texts(part, str(out), "doc", "text", mode=mode)
        folders.append({f for f in os.listdir(out) if f.startswith("folder=")} - set().union(*folders))
    assert all(folders)
    assert {r["value"] for r in FS.read_texts(spark, str(out)).collect()} == {f"{i}\ntext {i}\n" for i in range(60)}
    files = [f for _, _, fs in os.walk(out) for f in fs]
    assert len([f for f in files if f.endswith(".txt")]) == 60 and not [f for f in files if f.endswith(".crc")]
    for f in folders[1]:                                 # what the second arrival wrote lies apart
        assert all(int(open(out / f / x).readline()) >= 40 for x in os.listdir(out / f))
    SK.write_structure_texts(docs.limit(1), str(out), "doc", "text", compression="gzip")
    assert FS.read_texts(spark, str(out), glob="*.txt.gz").count() == FS.read_texts(spark, str(out)).count() == 1


def test_partition_values_are_escaped_as_spark_does(spark, tmp_path):
    names = ["a/b", "c:d %41", "x=y", None, "", "é [1]", "007"]
    df = spark.createDataFrame([(n, str(i), f"v{i}") for i, n in enumerate(names)],
                               "dataset string, structure string, value string")
    SK.write_parsed_summaries(df, str(tmp_path / "p"))
    df.select("value", "dataset").write.option("maxRecordsPerFile", 1).partitionBy("dataset").text(str(tmp_path / "q"))
    got = {r["value"]: r["dataset"] for r in FS.read_texts(spark, str(tmp_path / "p")).collect()}
    assert got == {r["value"]: r["dataset"] for r in FS.read_texts(spark, str(tmp_path / "q")).collect()}
    assert len(got) == len(names)


def test_listing_brings_no_path_to_python(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "empty.txt").write_text("")

    def no_paths(self):
        raise AssertionError("one call per file")
    monkeypatch.setattr(type(spark.range(1)), "inputFiles", no_paths)
    got = {r["file_name"]: r["length"] for r in FS.list_files(spark, str(tmp_path), "*.txt").collect()}
    assert got == {"a.txt": 1, "empty.txt": 0}
