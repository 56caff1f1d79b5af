"""Resumable command stage: what runs in which attempt, after kills, changes and failures."""

import os
import subprocess
import sys
import time
from collections import Counter

import pytest

from hitroll.plans import job
from hitroll.plans import ledger as LG
from hitroll.sources.catalogue import Entry

SCHEMA = "dataset string, structure string, value string"


def files(spark, n=40, changed=()):
    rows = [(f"d{i % 3}", f"s{i}.pdb", f"text {i}{' new' if i in changed else ''}") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def logger(folder):
    """Appends its structure's name to a file of its own per run; fails for names ending in 7."""
    return ["sh", "-c", f'echo x >> "{folder}/$1"; cat; case $1 in *7.pdb) exit 3;; esac', "sh", "{name}"]


def runs(folder):
    return Counter({f: len(open(os.path.join(folder, f)).readlines()) for f in os.listdir(folder)})


class Killed(Exception):
    pass


def test_restarted_stage_runs_the_rest_once(spark, tmp_path):
    log, ledger = tmp_path / "log", str(tmp_path / "ledger")
    log.mkdir()
    cmd = logger(log)

    def kill(batch, batches):
        assert batches == 4
        if batch == 1:
            raise Killed

    with pytest.raises(Killed):
        LG.run_stage(files(spark), cmd, ledger, batch_records=10, after_batch=kill)
    first = {r.structure for r in LG.read_ledger(spark, ledger).collect()}
    assert 0 < len(first) < 40 and set(runs(log)) == first
    # A batch that a killed driver left behind without committing it does not count.
    os.makedirs(f"{ledger}/attempt=1/batch=2")
    with open(f"{ledger}/attempt=1/batch=2/part-0.parquet", "wb") as fh:
        fh.write(b"half a file")
    out = LG.run_stage(files(spark), cmd, ledger, batch_records=10).collect()
    assert len(out) == 40 and set(runs(log).values()) == {1}
    assert {r.structure: r.attempt for r in out} == {f"s{i}.pdb": 1 if f"s{i}.pdb" in first else 2 for i in range(40)}
    assert {r.structure: r.rc for r in out} == {f"s{i}.pdb": 3 if i % 10 == 7 else 0 for i in range(40)}
    assert all(r.out == f"text {r.structure[1:-4]}" for r in out)
    # Nothing left: no further attempt. Changed, new and removed structures; another command.
    LG.run_stage(files(spark), cmd, ledger)
    assert LG.claim_attempt(spark, ledger) == 3
    out = LG.run_stage(files(spark, 42, changed={5, 6}).where("structure <> 's1.pdb'"), cmd, ledger).collect()
    assert len(out) == 41 and {r.structure for r in out if r.attempt == 4} == {"s5.pdb", "s6.pdb", "s40.pdb", "s41.pdb"}
    assert {n for n, k in runs(log).items() if k == 2} == {"s5.pdb", "s6.pdb"}
    # Back to the old content: both results are still there.
    assert {r.attempt for r in LG.run_stage(files(spark), cmd, ledger).collect()} == {1, 2}
    assert {r.attempt for r in LG.run_stage(files(spark), [*cmd, "more"], ledger).collect()} == {5}


def test_what_did_not_start_is_tried_again(spark, tmp_path):
    ledger, program = str(tmp_path / "ledger"), tmp_path / "late"
    cmd = [str(program)]
    assert {r.rc for r in LG.run_stage(files(spark, 6), cmd, ledger).collect()} == {-2}
    program.write_text("#!/bin/sh\ncat\n")
    program.chmod(0o755)
    out = LG.run_stage(files(spark, 6), cmd, ledger).collect()
    assert [(r.rc, r.attempt) for r in out] == [(0, 2)] * 6


def test_empty_input(spark, tmp_path):
    assert LG.run_stage(files(spark).limit(0), ["cat"], str(tmp_path / "ledger")).collect() == []


def test_job_with_a_ledger(spark, tmp_path):
    log, ledger = tmp_path / "log", str(tmp_path / "ledger")
    log.mkdir()
    entries = [Entry(f"d{k}", "", 1) for k in range(3)]
    first = job.run(spark, entries, str(tmp_path / "a"), logger(log), files=files(spark), ledger=ledger)
    again = job.run(spark, entries, str(tmp_path / "b"), logger(log), files=files(spark, 41), ledger=ledger)
    assert set(runs(log).values()) == {1} and len(runs(log)) == 41
    assert sum(first["outcomes"].values()) == 40 and sum(again["outcomes"].values()) == 41


KILLED = """
import sys
sys.path.insert(0, {root!r})
from hitroll.plans import ledger as LG
from hitroll.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
rows = [("d", f"s{{i}}.pdb", "x") for i in range(24)]
files = spark.createDataFrame(rows, "dataset string, structure string, value string")
LG.run_stage(files, {cmd!r}, {ledger!r}, batch_records=6)
"""


def test_killed_driver(spark, tmp_path):
    """The driver process is killed while a batch runs; the restarted stage does the rest."""
    log, ledger = tmp_path / "log", str(tmp_path / "ledger")
    log.mkdir()
    cmd = ["sh", "-c", f'echo x >> "{log}/$1"; sleep 0.5; cat', "sh", "{name}"]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    child = subprocess.Popen([sys.executable, "-c", KILLED.format(root=root, cmd=cmd, ledger=ledger)],
                             stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    for _ in range(600):
        if child.poll() is not None or len(LG.committed(spark, ledger)) >= 2:
            break
        time.sleep(0.1)
    child.kill()
    child.wait()
    time.sleep(2)                                     # children of the killed driver end
    done = {r.structure for r in LG.read_ledger(spark, ledger).collect()}
    assert 0 < len(done) < 24
    before = runs(log)
    rows = [("d", f"s{i}.pdb", "x") for i in range(24)]
    out = LG.run_stage(spark.createDataFrame(rows, SCHEMA), cmd, ledger, batch_records=6).collect()
    after = runs(log)
    assert len(out) == 24 and {r.structure for r in out if r.attempt == 1} == done
    assert {n for n in after if after[n] > before[n]} == {f"s{i}.pdb" for i in range(24)} - done
    assert all(after[n] - before[n] == 1 for n in after if n not in done)
