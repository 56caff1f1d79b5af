"""The external command stage (UDF1, UDF2, PT1): run a caller-supplied program on every
structure and keep its exit code, output files, standard output and standard error as columns.

This is the one step whose work is opaque to Spark, so it runs in ``mapInPandas``: rows arrive
in Arrow batches, each record is handed to the child process, and results go back as a batch.
The stage has no side effects besides the child process itself (results are returned, not
uploaded), so a retried task simply runs again. Failures, non-zero exits and timeouts become
rows (``rc`` -1 for a timeout, -2 when the program cannot be started), never task failures.

Input placement: file sources pack small files by bytes, while the cost here is per record, so
the caller states the least number of tasks (PT1); records are dealt out only if the scan has
fewer. Standard error and the outputs are kept whole.
"""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitroll.operators.dealing import deal_by_cost
from hitroll.sources.hits import HIT_DDL

INPUT = "{input}"     # placeholder in the argument list for the path of the record's content
NAME = "{name}"       # placeholder for the record's key

STAGE_SCHEMA = "rc int, out string, err string, files map<string,string>"


def _read(path: str) -> str | None:
    if not os.path.exists(path):
        return None
    with open(path, "rb") as fh:
        return fh.read().decode("utf-8", "replace")


@contextmanager
def _private_folder(parent: str):
    """A new folder in ``parent``, removed with what it holds. Most are left empty, and one ``rmdir``
    does; ``parent`` is the task's own, as tasks that share one wait for each other there."""
    d = os.path.join(parent, uuid.uuid4().hex)
    os.mkdir(d, 0o700)
    try:
        yield d
    finally:
        try:
            os.rmdir(d)
        except OSError:
            shutil.rmtree(d, ignore_errors=True)        # what withstands it goes with ``parent``


def _run_one(command: Sequence[str], name, content, timeout: float | None, parent: str,
             output_file: str | None, extra_files: Sequence[str], env: Mapping[str, str] | None):
    data = content.encode("utf-8") if isinstance(content, str) else bytes(content or b"")
    args = [a.replace(NAME, str(name)) for a in command]
    needs_file = any(INPUT in a for a in args)
    child_env = {**os.environ, **env} if env else None
    # Every record runs in a private scratch folder, removed afterwards: the child's input file
    # (closed before it starts) and any file it writes live only there.
    with _private_folder(parent) as d:
        try:
            if needs_file:
                p = os.path.join(d, "input")
                with open(p, "wb") as fh:
                    fh.write(data)
                args = [a.replace(INPUT, p) for a in args]
                r = subprocess.run(args, capture_output=True, timeout=timeout, cwd=d, env=child_env)
            else:
                r = subprocess.run(args, input=data, capture_output=True, timeout=timeout, cwd=d,
                                   env=child_env)
        except subprocess.TimeoutExpired:
            return -1, None, f"timeout after {timeout}s", {}
        except OSError as e:
            return -2, None, str(e), {}
        named = [f.replace(NAME, str(name)) for f in extra_files]
        files = {f: text for f in named if (text := _read(os.path.join(d, f))) is not None}
        err = r.stderr.decode("utf-8", "replace")
        if output_file is None:
            return r.returncode, r.stdout.decode("utf-8", "replace"), err, files
        # no output file: "no output" (R1)
        return r.returncode, _read(os.path.join(d, output_file.replace(NAME, str(name)))), err, files


def _scratch_root() -> str | None:
    """Inside a task: the executor's Spark-managed folder of this application (under
    ``spark.local.dir`` or the cluster manager's local folders), which Spark removes when the
    application ends, so a killed task leaves nothing behind on the machine."""
    from pyspark import SparkFiles
    try:
        return SparkFiles.getRootDirectory()
    except Exception:
        return None


def run_command(df: DataFrame, command: Sequence[str], key: str = "structure",
                content: str = "value", min_partitions: int | None = None,
                timeout: float | None = None, workdir: str | None = None,
                output_file: str | None = None, extra_files: Sequence[str] = (),
                env: Mapping[str, str] | None = None, keep: Sequence[str] = (),
                cost: Column | str | None = None) -> DataFrame:
    """Run ``command`` once per row; returns ``(*keep, key, rc, out, err, files)``.

    ``command`` is an argument list; ``{input}`` is replaced by a path holding the row's
    ``content`` (text or bytes), ``{name}`` by its key. Without ``{input}`` the content is
    written to the child's standard input. ``out`` is the child's standard output, or, with
    ``output_file`` (e.g. ``"{name}_search.tsv"``), the content of that file in the child's
    working folder, NULL when the child did not write it; ``files`` holds those of
    ``extra_files`` that it wrote, by name. Each child runs in a private folder under
    ``workdir``, by default under the executor's Spark-managed application folder, with ``env``
    added to the environment. There is no timeout unless one is given. With ``cost`` (say the length
    of the record's file) the records are dealt to ``min_partitions`` tasks of about equal cost.
    """
    cmd, keep = list(command), list(keep)
    if cost is not None:
        if not min_partitions:
            raise ValueError("dealing by cost needs min_partitions")
        df = deal_by_cost(df, cost, min_partitions, [*keep, key])
    src = df.select(*keep, F.col(key).alias("_key"), F.col(content).alias("_content"))
    if min_partitions and cost is None and src.rdd.getNumPartitions() < min_partitions:
        src = src.repartition(min_partitions, *keep, "_key")

    def stage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root = workdir or _scratch_root()
        with tempfile.TemporaryDirectory(dir=root) as parent:
            for pdf in batches:
                res = [_run_one(cmd, k, c, timeout, parent, output_file, extra_files, env)
                       for k, c in zip(pdf["_key"], pdf["_content"])]
                out = pdf.drop(columns="_content")
                for i, name in enumerate(("rc", "out", "err", "files")):
                    out[name] = [r[i] for r in res]
                yield out

    types = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    types.append(f"_key {df.schema[key].dataType.simpleString()}")
    return (src.mapInPandas(stage, f"{', '.join(types)}, {STAGE_SCHEMA}")
            .withColumnRenamed("_key", key))


def has_output(column: str = "out"):
    """R1, R8: an output counts if it holds a header line; a missing or empty one is no output."""
    return F.coalesce(F.length(column) > 0, F.lit(False))


# A record of a tab-separated file: fields up to a line end that is not inside a quoted cell.
# Quoting starts only at the beginning of a field; a doubled quote inside stands for one.
_FIELD = r'(?:"(?:[^"]++|"")*+"?[^\t\r\n]*+|[^\t\r\n]*+)'
RECORD = rf"{_FIELD}(?:\t{_FIELD})*+(?:\r\n|\n|\r|\z)"


def hits_from_output(stage_out: DataFrame, keys: list[str], column: str = "out") -> DataFrame:
    """Hit rows from a command's tab-separated output (header record first), parsed on the JVM.

    The text is cut into records with quoted line ends kept inside their cell; the header and
    blank records are dropped, and each record is parsed with ``from_csv`` using the quoting of
    the hit-file reader. Returns ``(*keys, c0..c15)``, ready for ``sources.hits.parse_hits``.
    """
    opts = {"sep": "\t", "quote": '"', "escape": '"', "multiLine": "true",
            "maxCharsPerColumn": "-1"}
    records = F.regexp_extract_all(F.col(column), F.lit(RECORD), F.lit(0))
    lines = stage_out.select(*keys, F.posexplode(records).alias("pos", "line"))
    rows = lines.where((F.col("pos") > 0) & (F.trim(F.translate("line", "\r\n", "")) != ""))
    rows = rows.withColumn("line", F.regexp_replace("line", r"(?:\r\n|\n|\r)\z", ""))
    return rows.select(*keys, F.from_csv("line", HIT_DDL, opts).alias("r")).select(*keys, "r.*")
