"""The entry module loaded by path from another folder, in a default session: Python-stage
queries must run on workers that do not have this repository on their path."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
print("entry", len(E.entry(spark).collect()))
for name in ("external_command_stage", "label_top_k"):
    print(name, len(E.queries()[name](spark, "/root/testdata/sf0.001").collect()))
spark.stop()
"""


def test_entry_loaded_by_path_in_a_default_session():
    with tempfile.TemporaryDirectory() as d:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env, capture_output=True,
                           text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    lines = dict(line.split() for line in r.stdout.splitlines() if line.count(" ") == 1)
    assert lines["entry"] == "5"
    assert lines["external_command_stage"] == "200"
    assert int(lines["label_top_k"]) > 0
