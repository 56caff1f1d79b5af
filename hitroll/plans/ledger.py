"""A durable ledger of finished structures, so that a job can be resumed (PT4, SRC5).

The command stage is the expensive part of the job. With a ledger its results go, batch by batch,
to a folder of the caller's that outlives the application:

    <ledger>/attempt=<n>/batch=<k>/part-*.parquet, _SUCCESS

A batch is one Spark job with Spark's commit protocol, so its results and the fact that its
structures are finished appear together, and batches without ``_SUCCESS`` do not count. An
attempt first anti-joins the ledger: a structure is finished if the same content was run by the
same command (its arguments, output files and environment) with an exit code of its own. What
could not be started or ran out of time is tried again; so is whatever a killed driver had not
committed. Changed structures run again, removed ones drop out of the results.

Two jobs may share a ledger: an attempt's number is claimed by creating a file that must not exist.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitroll.operators import external as X
from hitroll.schema import DATASET, STRUCTURE
from hitroll.session import scratch_path

KEYS = [DATASET, STRUCTURE]
BATCH_RECORDS = 100_000
LEDGER_SCHEMA = ("dataset string, structure string, fingerprint string, rc int, out string, "
                 "err string, files map<string,string>")


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def signature(command: Sequence[str], output_file: str | None = None,
              extra_files: Sequence[str] = (), env: Mapping[str, str] | None = None) -> str:
    """What makes two runs of one structure alike, besides its content."""
    parts = [list(command), output_file, sorted(extra_files), sorted((env or {}).items())]
    return hashlib.md5(json.dumps(parts).encode()).hexdigest()


def batch_of(n: int, keys: Sequence[str] = KEYS) -> Column:
    """Batch of a structure, from its key alone."""
    digest = F.md5(F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def committed(spark: SparkSession, ledger: str) -> list[str]:
    """Folders of the committed batches."""
    fs, root = _fs(spark, ledger)
    if not fs.exists(root):
        return []
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "attempt=*/batch=*/_SUCCESS"))
    return sorted(str(f.getPath().getParent().toString()) for f in found)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All committed rows, with their ``attempt`` and ``batch``."""
    folders = committed(spark, ledger)
    schema = f"{LEDGER_SCHEMA}, attempt int, batch int"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", ledger).parquet(*folders)


def _finished(rows: DataFrame) -> DataFrame:
    return rows.where("rc >= 0")


def claim_attempt(spark: SparkSession, ledger: str) -> int:
    """The number of a new attempt; no other job can get the same one."""
    fs, root = _fs(spark, ledger)
    fs.mkdirs(root)
    marks = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "_attempt-*"))
    n = max([0, *(int(m.getPath().getName().rsplit("-", 1)[1]) for m in marks)])
    while True:
        n += 1
        mark = spark._jvm.org.apache.hadoop.fs.Path(root, f"_attempt-{n}")
        if fs.createNewFile(mark):
            return n


def run_stage(files: DataFrame, command: Sequence[str], ledger: str, *,
              batch_records: int = BATCH_RECORDS, records_per_task: int = 256, min_partitions: int = 1,
              after_batch: Callable[[int, int], None] | None = None, timeout: float | None = None,
              output_file: str | None = None, extra_files: Sequence[str] = (),
              env: Mapping[str, str] | None = None) -> DataFrame:
    """``dataset, structure, rc, out, err, files, attempt`` of the command on every row of
    ``files`` (dataset, structure, value), running only what the ledger does not hold yet.

    ``after_batch(batch, batches)`` is called after each commit; what it raises ends the attempt.
    """
    spark = files.sparkSession
    sign = signature(command, output_file, extra_files, env)
    value = F.coalesce(F.col("value").cast("binary"), F.lit(b""))
    keyed = files.select(*[F.col(k).cast("string").alias(k) for k in KEYS], "value",
                         F.concat_ws("-", F.lit(sign), F.md5(value)).alias("fingerprint"))
    by = [*KEYS, "fingerprint"]
    done = _finished(read_ledger(spark, ledger)).select(*by).distinct()
    # One pass over the files: the keys of all, and the content of those that remain, by batch.
    every = f"{scratch_path(spark, 'ledger')}"
    keyed.select(*by).write.parquet(f"{every}/keys")
    keys = spark.read.schema(", ".join(f"{c} string" for c in by)).parquet(f"{every}/keys")
    left = keys.join(done, by, "left_anti")
    n = left.count()
    if n:
        batches = math.ceil(n / batch_records)
        attempt = claim_attempt(spark, ledger)
        todo = keyed.join(left, by, "left_semi").withColumn("batch", batch_of(batches).cast("int"))
        todo.write.partitionBy("batch").parquet(f"{every}/todo")
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in todo.schema)
        todo = spark.read.schema(types).parquet(f"{every}/todo")
        for b in range(batches):
            part = todo.where(F.col("batch") == b).drop("batch")
            tasks = max(min_partitions, math.ceil(min(n, batch_records) / records_per_task))
            ran = X.run_command(part, command, key=STRUCTURE, content="value",
                                keep=[DATASET, "fingerprint"], min_partitions=tasks, timeout=timeout,
                                output_file=output_file, extra_files=extra_files, env=env)
            (ran.select(*[c.split()[0] for c in LEDGER_SCHEMA.split(", ")])
             .write.mode("overwrite").parquet(f"{ledger}/attempt={attempt}/batch={b}"))
            if after_batch:
                after_batch(b, batches)
    # A structure's result is its latest one: what failed to start may have run since.
    rows = read_ledger(spark, ledger).join(keys.distinct(), by, "left_semi")
    latest = Window.partitionBy(*by).orderBy(F.desc(F.col("rc") >= 0), F.desc("attempt"), F.desc("batch"))
    return (rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1")
            .select(*KEYS, "rc", "out", "err", "files", "attempt"))
