"""End-to-end batch job on hand-made structure files with a stand-in search program."""

import csv
import gzip
import os
import subprocess
import sys

import pytest

from hitroll.plans import job
from hitroll.sources.catalogue import Entry, resolve
from test_external import SEARCH


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def read_csv(path):
    with open(path) as fh:
        return list(csv.DictReader(fh))


def test_job_end_to_end_and_rerun(spark, tmp_path):
    d1, d2, out = str(tmp_path / "ds1"), str(tmp_path / "ds2"), str(tmp_path / "out")
    write(d1, "a.pdb", "alpha x\nbeta y\n")        # lines 7 and 6 long: mean 6.5
    write(d1, "b.pdb", "alpha zz\n")               # 8
    write(d1, "c.pdb", "\n")                       # the program writes nothing: no output
    write(d1, "ignored.cif", "alpha\n")            # not a structure file
    with gzip.open(os.path.join(d1, "ignored.cif.gz"), "wt") as fh:
        fh.write("alpha\n")
    write(d2, "d.pdb", "gamma\n")                  # 5
    script = tmp_path / "search.py"
    script.write_text(SEARCH)
    entries = [Entry("one", d1, 2), Entry("two", d2, 1), Entry("three", str(tmp_path / "ds3"), 1)]
    os.makedirs(str(tmp_path / "ds3"))
    res = job.run(spark, entries, out, [sys.executable, str(script), "{input}", "{name}"],
                  output_file="{name}_search.tsv")
    assert res["outcomes"] == {"hits": 3, "no_output": 1}
    assert res["files"] == 4
    stats = {r["organism"]: r for r in read_csv(f"{out}/plDDT_means.csv")}
    assert float(stats["one"]["mean plddt"]) == pytest.approx(7.25)    # mean of 6.5 and 8
    assert float(stats["one"]["plddt std"]) == pytest.approx(0.75)
    assert float(stats["two"]["mean plddt"]) == pytest.approx(5.0)
    assert float(stats["three"]["mean plddt"]) == 0.0                  # empty dataset (R5)
    codes = {r["cath_code"]: int(r["count"]) for r in read_csv(f"{out}/one_cath_summary.csv")}
    assert codes == {"alpha": 2, "beta": 1}
    assert read_csv(f"{out}/three_cath_summary.csv") == []
    # rerun with new data: the second result replaces the first (R17)
    write(d2, "e.pdb", "gamma gamma gamma\n")
    job.run(spark, entries, out, [sys.executable, str(script), "{input}", "{name}"],
            output_file="{name}_search.tsv")
    stats = {r["organism"]: r for r in read_csv(f"{out}/plDDT_means.csv")}
    assert float(stats["two"]["mean plddt"]) == pytest.approx((5 + 17) / 2)


def test_names_are_normalised_and_checked():
    cat = job.parse_catalogue(None)
    assert [e.name for e in resolve([" ECOLI", "human", "ecoli"], cat)] == ["ecoli", "human"]
    with pytest.raises(ValueError, match="not in the catalogue"):
        resolve(["mouse"], cat)
    assert job.parse_catalogue(["x=/data/x/:4"])[0] == Entry("x", "/data/x/", 4)


def test_unknown_names_as_dataframe(spark):
    from hitroll.sources.catalogue import catalogue_df, unknown_names
    cat = catalogue_df(spark, job.parse_catalogue(None))
    req = spark.createDataFrame([(" Human ",), ("mouse",), ("ECOLI",)], "dataset string")
    assert [r[0] for r in unknown_names(req, cat).collect()] == ["mouse"]


def test_job_from_existing_hit_files(spark, tmp_path):
    ds, hits, out = str(tmp_path / "ds"), str(tmp_path / "hits"), str(tmp_path / "out")
    for name in ("a.pdb", "b.pdb", "c.pdb"):
        write(ds, name, "ATOM\n")
    header = "\t".join(f"h{i}" for i in range(16)) + "\n"

    def row(score, code):
        return "\t".join(["q", "t", "x", score] + ["f"] * 11 + ['{"cath": "%s"}' % code]) + "\n"
    write(hits, "a.pdb_search.tsv", header + row("90", "1.10") + row("70", "2.20"))
    write(hits, "b.pdb_search.tsv", header)                       # zero hits: mean 0, counted
    res = job.run(spark, [Entry("one", ds, 1)], out, hits_dir=hits)  # c.pdb: no hit file
    assert res["outcomes"] == {"hits": 1, "zero_hits": 1, "no_output": 1}
    stats = read_csv(f"{out}/plDDT_means.csv")[0]
    assert float(stats["mean plddt"]) == pytest.approx(40.0)         # mean of 80 and 0
    assert float(stats["plddt std"]) == pytest.approx(40.0)
    codes = {r["cath_code"]: int(r["count"]) for r in read_csv(f"{out}/one_cath_summary.csv")}
    assert codes == {"1.10": 1, "2.20": 1}


def test_job_with_incremental_ingest(spark, tmp_path):
    d1, out, ing = str(tmp_path / "ds"), str(tmp_path / "out"), str(tmp_path / "ingest")
    write(d1, "a.pdb", "alpha x\n")
    script = tmp_path / "search.py"
    script.write_text(SEARCH)
    cmd = [sys.executable, str(script), "{input}", "{name}"]
    res = job.run(spark, [Entry("one", d1, 1)], out, cmd, output_file="{name}_search.tsv",
                  ingest_dir=ing)
    assert res["outcomes"] == {"hits": 1} and res["files"] == 1
    write(d1, "b.pdb", "beta yy\ngamma zzz\n")        # arrives later: only b is ingested now
    res = job.run(spark, [Entry("one", d1, 1)], out, cmd, output_file="{name}_search.tsv",
                  ingest_dir=ing)
    assert res["outcomes"] == {"hits": 2} and res["files"] == 2
    table = spark.read.parquet(f"{ing}/one/table")
    assert sorted(r["file_name"] for r in table.collect()) == ["a.pdb", "b.pdb"]
    stats = {r["organism"]: r for r in read_csv(f"{out}/plDDT_means.csv")}
    assert float(stats["one"]["mean plddt"]) == pytest.approx((7 + (7 + 9) / 2) / 2)


def test_job_reads_gzip_structures(spark, tmp_path):
    d1, out = str(tmp_path / "ds"), str(tmp_path / "out")
    os.makedirs(d1)
    with gzip.open(os.path.join(d1, "z.pdb.gz"), "wt") as fh:     # read without unpacking
        fh.write("delta abc\n")
    write(d1, "y.pdb", "eps\n")
    script = tmp_path / "search.py"
    script.write_text(SEARCH)
    res = job.run(spark, [Entry("one", d1, 1)], out,
                  [sys.executable, str(script), "{input}", "{name}"], output_file="{name}_search.tsv")
    assert res["outcomes"] == {"hits": 2}
    rows = {r["structure"]: r["mean_score"] for r in spark.read.parquet(f"{out}/structures").collect()}
    assert rows == {"z.pdb": 9.0, "y.pdb": 3.0}


def _job_cli(tmp_path, *args):
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    return subprocess.run([sys.executable, "-m", "hitroll.plans.job", *args], cwd=str(tmp_path),
                          env=env, capture_output=True, text=True, timeout=600)


def test_job_wrapper_end_to_end_with_sizing(tmp_path):
    d1, out = str(tmp_path / "ds"), str(tmp_path / "out")
    write(d1, "a.pdb", "alpha x\n")
    write(d1, "b.pdb", "beta yy\ngamma zzz\n")
    script = tmp_path / "search.py"
    script.write_text(SEARCH)
    r = _job_cli(tmp_path, " One ", "--catalogue", f"one={d1}:2", "--out", out,
                 "--command", f"{sys.executable} {script} {{input}} {{name}}",
                 "--output-file", "{name}_search.tsv", "--input-bytes", str(1 << 30),
                 "--total-cores", "8")
    assert r.returncode == 0, r.stderr[-2000:]
    stats = read_csv(f"{out}/plDDT_means.csv")
    assert [s["organism"] for s in stats] == ["one"]
    assert float(stats[0]["mean plddt"]) == pytest.approx(7.5)
    assert float(stats[0]["plddt std"]) == pytest.approx(0.5)
    codes = {r["cath_code"]: int(r["count"]) for r in read_csv(f"{out}/one_cath_summary.csv")}
    assert codes == {"alpha": 1, "beta": 1, "gamma": 1}


def test_job_wrapper_rejects_unknown_names(tmp_path):
    r = _job_cli(tmp_path, "mouse", "--out", str(tmp_path / "out"))
    assert r.returncode != 0
    assert "mouse" in r.stderr and "ecoli" in r.stderr


HEADER = "\t".join(f"h{i}" for i in range(16)) + "\n"


def hit(score, code):
    return "\t".join(["q", "t", "x", score] + ["f"] * 11 + ['{"cath": "%s"}' % code]) + "\n"


def test_datasets_with_the_same_file_names_stay_apart(spark, tmp_path):
    d1, d2, hits, out = (str(tmp_path / n) for n in ("d1", "d2", "hits", "out"))
    for d, text in ((d1, "alpha\n"), (d2, "gamma gamma\n")):
        write(d, "x.pdb", text)
    entries = [Entry("one", d1, 1), Entry("two", d2, 1)]
    script = tmp_path / "search.py"
    script.write_text(SEARCH)
    cmd = [sys.executable, str(script), "{input}", "{name}"]
    job.run(spark, entries, out, cmd, output_file="{name}_search.tsv")
    stats = {r["organism"]: float(r["mean plddt"]) for r in read_csv(f"{out}/plDDT_means.csv")}
    assert stats == {"one": 5.0, "two": 11.0}
    assert [r["cath_code"] for r in read_csv(f"{out}/one_cath_summary.csv")] == ["alpha"]
    assert [r["cath_code"] for r in read_csv(f"{out}/two_cath_summary.csv")] == ["gamma"]
    write(f"{hits}/one", "x.pdb_search.tsv", HEADER + hit("10", "a"))
    write(f"{hits}/two", "x.pdb_search.tsv", HEADER + hit("90", "b"))
    job.run(spark, entries, out, hits_dir=hits)
    stats = {r["organism"]: float(r["mean plddt"]) for r in read_csv(f"{out}/plDDT_means.csv")}
    assert stats == {"one": 10.0, "two": 90.0}


def test_failed_and_empty_outputs_are_no_output(spark, tmp_path):
    ds, out = str(tmp_path / "ds"), str(tmp_path / "out")
    write(ds, "a.pdb", "x\n")
    write(ds, "b.pdb", "y\n")
    res = job.run(spark, [Entry("one", ds, 1)], out, ["false"])
    assert res["outcomes"] == {"no_output": 2}
    stats = read_csv(f"{out}/plDDT_means.csv")
    assert [(r["organism"], float(r["mean plddt"])) for r in stats] == [("one", 0.0)]
    res = job.run(spark, [Entry("one", ds, 1)], out, ["sh", "-c", ": > $0_search.tsv", "{name}"],
                  output_file="{name}_search.tsv")
    assert res["outcomes"] == {"no_output": 2}
    header = f"printf '{HEADER.strip()}' > $0_search.tsv"
    res = job.run(spark, [Entry("one", ds, 1)], out, ["sh", "-c", header, "{name}"],
                  output_file="{name}_search.tsv")
    assert res["outcomes"] == {"zero_hits": 2}


def test_unpacked_file_wins_and_empty_files_count(spark, tmp_path):
    ds, out = str(tmp_path / "ds"), str(tmp_path / "out")
    write(ds, "x.pdb", "alpha\n")
    with gzip.open(os.path.join(ds, "x.pdb.gz"), "wt") as fh:
        fh.write("alpha\nalpha\n")
    write(ds, "empty.pdb", "")
    script = tmp_path / "search.py"
    script.write_text(SEARCH)
    cmd = [sys.executable, str(script), "{input}", "{name}"]
    for ingest in (None, str(tmp_path / "ingest")):
        res = job.run(spark, [Entry("one", ds, 1)], out, cmd, output_file="{name}_search.tsv",
                      ingest_dir=ingest)
        assert res["outcomes"] == {"hits": 1, "no_output": 1} and res["files"] == 2
        codes = {r["cath_code"]: int(r["count"]) for r in read_csv(f"{out}/one_cath_summary.csv")}
        assert codes == {"alpha": 1}


def test_job_publishes_hits_summaries_and_further_files(spark, tmp_path):
    from hitroll.sources import files as FS
    ds, out = str(tmp_path / "ds"), str(tmp_path / "out")
    write(ds, "a.pdb", "alpha x\nbeta y\n")
    write(ds, "b.pdb", "\n")
    script = tmp_path / "search.py"
    script.write_text(SEARCH + '\nopen(name + "_segment.tsv", "w").write("seg " + name)\n')
    job.run(spark, [Entry("one", ds, 1)], out, [sys.executable, str(script), "{input}", "{name}"],
            output_file="{name}_search.tsv", extra_files=["{name}_segment.tsv"], compression="gzip")
    assert spark.read.parquet(f"{out}/hits").where("dataset = 'one'").count() == 2
    files = spark.read.parquet(f"{out}/files").collect()
    assert [(r["structure"], r["file_name"], r["content"]) for r in files] == [
        ("a.pdb", "a.pdb_segment.tsv", "seg a.pdb")]
    parsed = FS.parse_parsed_summary(FS.read_texts(spark, f"{out}/parsed", glob="*.txt.gz"),
                                     file_col="structure").collect()
    assert [(r["structure"], r["mean_score"], len(r["entries"])) for r in parsed] == [("a.pdb", 6.5, 2)]
    assert any(n.endswith(".csv.gz") for n in os.listdir(f"{out}/code_summaries"))
