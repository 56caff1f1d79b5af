"""Hit files written by hand, one per edge case of FIXTURES.md (rules R1, R7-R12, R16, R21)."""

import csv
import json
import os

from pyspark.sql import functions as F

from hitroll.functions.columns import with_json_check
from hitroll.operators import scores as S
from hitroll.sources import hits as HF

HEADER = "\t".join(f"h{i}" for i in range(16)) + "\n"


def row(score="90.5", meta='{"cath": "3.40.710.10"}', n=16):
    cells = ["q", "t", "x", score] + ["f"] * 11 + [meta]
    return "\t".join(cells[:n]) + "\n"


def quoted(meta):
    return '"' + meta.replace('"', '""') + '"'


CASES = {
    "normal.pdb": HEADER + row("90") + row("80", '{"cath": "2.30.810.20"}'),
    "header_only.pdb": HEADER,
    "zero_bytes.pdb": "",
    "bad_score.pdb": HEADER + row("90") + row("xx"),
    "short_row.pdb": HEADER + row("90", n=10),
    "bad_json.pdb": HEADER + row(meta="{"),
    "empty_obj.pdb": HEADER + row(meta="{}"),
    "nested.pdb": HEADER + row(meta='{"cath": {"q": 1}}'),
    "null_code.pdb": HEADER + row(meta='{"cath": null}'),
    "comma_code.pdb": HEADER + row(meta='{"cath": "a,b"}'),
    "quoted_cell.pdb": HEADER + row(meta=quoted('{"cath": "2.60.40.10"}')),
    "spellings.pdb": HEADER + row("1_0") + row(" 7 "),
    "suffix90d.pdb": HEADER + row("90d"),
    "sample": HEADER + row("50"),
    "line_end.pdb": HEADER + row("60").replace("t", '"two\nlines"', 1) + row("40"),
}


def write_cases(folder):
    for name, text in CASES.items():
        with open(os.path.join(folder, f"{name}_search.tsv"), "w") as fh:
            fh.write(text)


def test_hit_scan_edge_cases(spark, tmp_path):
    folder = str(tmp_path)
    write_cases(folder)
    hits = HF.parse_hits(HF.read_hit_files(spark, folder))
    by = {}
    for r in hits.collect():
        by.setdefault(r["structure"], []).append(r)
    assert "header_only.pdb" not in by and "zero_bytes.pdb" not in by
    assert sorted(r["score"] for r in by["normal.pdb"]) == [80.0, 90.0]
    assert {r["reason"] for r in by["bad_score.pdb"]} == {None, "bad_score"}
    assert by["short_row.pdb"][0]["reason"] == "missing_field"
    assert by["bad_json.pdb"][0]["reason"] == "bad_json"
    assert by["empty_obj.pdb"][0]["reason"] == "missing_key"
    assert by["nested.pdb"][0]["reason"] == "nested_value"
    assert by["null_code.pdb"][0]["code"] == "None"
    assert by["comma_code.pdb"][0]["code"] == "a,b"
    assert by["quoted_cell.pdb"][0]["code"] == "2.60.40.10"
    assert sorted(r["score"] for r in by["spellings.pdb"]) == [7.0, 10.0]
    assert by["suffix90d.pdb"][0]["bad"]
    assert sorted(r["score"] for r in by["line_end.pdb"]) == [40.0, 60.0]
    assert "sample" in by   # R16 fixed: the literal suffix is removed, not a character set


def test_outcomes_from_files(spark, tmp_path):
    folder = str(tmp_path)
    write_cases(folder)
    names = [n for n in CASES] + ["no_hit_file.pdb"]
    universe = spark.createDataFrame([(n, "ds") for n in names], "structure string, dataset string")
    hits = HF.parse_hits(HF.read_hit_files(spark, folder))
    listed = HF.list_hit_files(spark, folder)
    out = {r["structure"]: r["outcome"]
           for r in S.outcomes(universe, S.per_structure(hits), listed).collect()}
    assert out["normal.pdb"] == "hits"
    assert out["header_only.pdb"] == "zero_hits"       # R1: counted with mean 0
    assert out["zero_bytes.pdb"] == "no_output"        # R8
    assert out["no_hit_file.pdb"] == "no_output"       # R1
    for bad in ("bad_score.pdb", "short_row.pdb", "bad_json.pdb", "empty_obj.pdb", "nested.pdb",
                "suffix90d.pdb"):
        assert out[bad] == "rejected", bad              # R7: the whole structure
    assert out["null_code.pdb"] == "hits" and out["comma_code.pdb"] == "hits"
    rej = {r["structure"]: r["reasons"] for r in HF.rejects(hits).collect()}
    assert rej["bad_score.pdb"] == ["bad_score"]
    stats = S.dataset_statistics(S.scored(S.outcomes(universe, S.per_structure(hits), listed)))
    assert stats.first()["n_structures"] == sum(v in ("hits", "zero_hits") for v in out.values())


def test_rejects_from_grain_match_row_rejects(spark, tmp_path):
    folder = str(tmp_path)
    write_cases(folder)
    hits = HF.parse_hits(HF.read_hit_files(spark, folder))
    want = sorted(tuple(r) for r in HF.rejects(hits).collect())
    got = sorted(tuple(r) for r in S.rejects_from_grain(S.code_grain(hits)).collect())
    assert got == want and len(got) == 6


def python_code(cell):
    try:
        code = json.loads(cell)["cath"]
        {code: 0}
        return str(code)
    except (ValueError, KeyError, TypeError):
        return None


def test_json_cells_as_python_reads_them(spark):
    cells = ['{"cath":"a"}', '{"cath":"a"} x', '{"cath":"a","cath":"b"}', '{"cath":NaN}', '{"cath":"NaN"}',
             '{"cath":-Infinity}', '{"cath":Infinity,"x":1}', '{"cath":INF}', '{"cath":-INF}',
             '{"cath":+INF}', '{"x":+Infinity,"cath":"q"}', '{"x":NaN,"cath":"q+INF"}', '{"cath":null}',
             '{"cath":"a","cath":null}', '{}', '[1]', "1", "", "null", ' {"cath":1.5}\n', '{"cath":"a"}] x',
             '{"cath":"a"}} x', '{"cath":"a"}, {"cath":"b"}', '{"cath":"a"},', "{'cath':'a'}", '{"cath":"a',
             '{"cath":{"q":1,"q":2}}', '{"cath":true,"x":{"a":1,"a":2}}', '{"cath":"a","cath":"b"}] z',
             '{"cath":"a","cath":"b"}} z', '{"x":NaN}', '{"x":[1],"cath":"]"}', '{"cath":[NaN]}',
             '{"cath":"\\"NaN\\"","x":NaN}', '{"cath":"a\\\\","x":NaN,"y":1e+5}', '{"cath":01}',
             '{"cath":1,"cath":{"q":1,"q":2}}', '{"cath":"{b","x":NaN}', '{"cath":"a","cath":[NaN]}',
             '{"cath":"a\tb"}', '{"cath":"é\\u00e9"}', '{"cath":"NaN","cath":"NaN"}', '{"cath":false}']
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "i int, cell string")
    got = with_json_check(df, "cell", "cath").orderBy("i").collect()
    assert [(c, r["_code"]) for c, r in zip(cells, got)] == [(c, python_code(c)) for c in cells]
    assert all((r["_code"] is None) == (r["_json_reason"] is not None) for r in got)


def test_records_as_python_reads_them(spark, tmp_path):
    plain = row("60").replace("t", '"two\n\nlines"', 1)
    cases = {**CASES, "blank.pdb": HEADER + row("90") + "\n" + row("80"), "last.pdb": HEADER + row("1") + "\n",
             "open.pdb": HEADER + row("90") + row("70").rstrip("\n"), "spaces.pdb": HEADER + row() + "  \n",
             "returns.pdb": (HEADER + row("90") + "\n" + row("80")).replace("\n", "\r\n"),
             "quoted.pdb": HEADER + plain + "\n" + plain, "mark.pdb": HEADER + row("1").replace("q", "\1n\1b")}
    for name, text in cases.items():
        with open(tmp_path / f"{name}_search.tsv", "w", newline="") as fh:
            fh.write(text)
    want = {}
    for name in cases:
        with open(tmp_path / f"{name}_search.tsv") as fh:
            next(fh, None)
            want[name] = [(k + 1, r[:4] if len(r) > 3 else None)
                          for k, r in enumerate(csv.reader(fh, delimiter="\t"))]
    raw = HF.scan_records(spark, str(tmp_path))
    got = {name: [] for name in cases}
    for r in raw.orderBy("file_name", "record").collect():
        fields = [r[f"c{k}"] for k in range(4)]
        got[r["file_name"][:-len("_search.tsv")]].append((r["record"], fields if fields[3] is not None else None))
    assert got == want
    bad = {r["structure"] for r in HF.rejects(HF.parse_hits(raw)).collect()}
    assert {"blank.pdb", "last.pdb", "spaces.pdb", "returns.pdb", "quoted.pdb"} <= bad
    assert not {"open.pdb", "mark.pdb", "normal.pdb", "line_end.pdb"} & bad


def test_hit_records_makes_no_folder_per_structure(spark, monkeypatch):
    import os

    from hitroll import queries as Q
    paths, real = [], Q.scratch_path

    def noted(session, name):
        paths.append(real(session, name))
        return paths[-1]
    monkeypatch.setattr(Q, "scratch_path", noted)
    n = Q.hit_records(spark, "/root/testdata/sf0.001").count()
    assert n > 1 and os.listdir(paths[0].removeprefix("file:")) == ["records"]
