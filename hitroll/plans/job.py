"""The batch job (Entry A, PT4): annotate every structure file of the requested datasets and
write the per-dataset statistics and code summaries.

    spark-submit --py-files hitroll.zip scripts/run_job.py --out /summary_outputs \\
        --command 'python3 search.py easy-search {input} db {name} tmp' \\
        --output-file '{name}_search.tsv' ecoli human

One logical plan for all datasets (the reference loops over them one job at a time). A structure
is known by its dataset and its file name:

1. list the structure files of every dataset without opening them: the universe;
2. run the search command per structure (``mapInPandas``), or read existing hit files;
3. **write the stage output** to the shared folder (Parquet): the expensive, opaque step is never
   recomputed, each structure file is opened once, and lineage is cut for the rest of the job
   (executors may be lost at any time);
4. parse hit rows once into the (dataset, structure, code) grain (written), reject malformed
   structures as a unit, compute the outcome of every structure;
5. publish, partitioned by dataset: the per-structure table, hit rows, parsed summaries, the
   command's further output files, rejects and failures; then one statistics CSV
   (``plDDT_means.csv``) and one code-summary CSV per dataset (``<dataset>_cath_summary.csv``).
"""

from __future__ import annotations

import argparse
import logging
import math
import shlex
import sys
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hitroll.fixed import (CODE_KEY, CODE_SUMMARY_COLUMNS, CODE_SUMMARY_SUFFIX, DATASETS,
                           DEFAULT_MIN_PARTITIONS, PACKED_GLOB, PLAIN_GLOB, STATISTICS_COLUMNS,
                           STATISTICS_FILE)
from hitroll.operators import external as X
from hitroll.operators import scores as S
from hitroll.plans import ledger as LG
from hitroll.schema import CODE, DATASET, STRUCTURE
from hitroll.session import build_session, scratch_path, sizing_conf
from hitroll.sinks import files as SK
from hitroll.sources import files as FS
from hitroll.sources import hits as HF
from hitroll.sources.catalogue import Entry, catalogue_df, resolve
from hitroll.streaming.ingest import ingest_texts

log = logging.getLogger("hitroll.job")

DEFAULT_CATALOGUE = [Entry(name, path, parts) for name, path, parts in DATASETS]


def parse_catalogue(specs: list[str] | None) -> list[Entry]:
    """``name=path[:partitions]`` entries; the reference's two datasets when none are given."""
    if not specs:
        return list(DEFAULT_CATALOGUE)
    out = []
    for s in specs:
        name, rest = s.split("=", 1)
        path, _, parts = rest.rpartition(":") if rest.rsplit(":", 1)[-1].isdigit() else (rest, "", "")
        out.append(Entry(name, path, int(parts) if parts else DEFAULT_MIN_PARTITIONS))
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df


def structure_files(spark: SparkSession, entries: list[Entry],
                    ingest_dir: str | None = None) -> DataFrame:
    """(dataset, structure, value): one row per structure file of every dataset.

    With ``ingest_dir``, each dataset folder is first ingested incrementally (only files not
    seen by an earlier run) into a Parquet table under ``<ingest_dir>/<dataset>``, and the rows
    come from that table: many small files are opened once, not on every run.
    """
    parts = []
    for e in entries:
        if ingest_dir:
            base = f"{ingest_dir.rstrip('/')}/{e.name}"
            glob = "{" + f"{PLAIN_GLOB},{PACKED_GLOB}" + "}"
            ingest_texts(spark, e.path, f"{base}/table", f"{base}/checkpoint", glob=glob,
                         run_tag=int(time.time()))
            texts = _ingested(spark, e.path, f"{base}/table")
        else:
            texts = FS.structure_texts(spark, e.path, PLAIN_GLOB, PACKED_GLOB)
        parts.append(texts.select(F.lit(e.name).alias(DATASET), STRUCTURE, "value"))
    return _union(parts)


def _ingested(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Structures of an ingested table: the unpacked file wins over the packed one; files without
    bytes come from the listing."""
    rows = spark.read.parquet(table).select("file_name", "value")
    empty = (FS.list_files(spark, path, PLAIN_GLOB).where("length = 0")
             .select("file_name", F.lit("").alias("value")))
    rows = rows.unionByName(empty)
    packed = F.col("file_name").endswith(".gz")
    name = F.regexp_replace("file_name", r"\.gz$", "").alias(STRUCTURE)
    plain = rows.where(~packed).select(name, "value")
    return plain.unionByName(rows.where(packed).select(name, "value")
                             .join(plain.select(STRUCTURE).distinct(), STRUCTURE, "left_anti"))


def universe_of(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    """(dataset, structure) of every structure file, from listings alone."""
    return _union([FS.structure_names(spark, e.path, PLAIN_GLOB, PACKED_GLOB)
                   .select(F.lit(e.name).alias(DATASET), STRUCTURE) for e in entries])


KEYS = [DATASET, STRUCTURE]
RECORDS_PER_TASK = 256      # of the command stage; layout only


def command_stage(files: DataFrame, command: Sequence[str], min_partitions: int, records: int,
                  **options) -> DataFrame:
    """``dataset, structure, rc, out, err, files`` of the command run on every structure, in at
    least ``min_partitions`` tasks (PT1) and in more where the structures are many."""
    n = max(min_partitions, math.ceil(records / RECORDS_PER_TASK))
    return X.run_command(files, command, key=STRUCTURE, content="value", keep=[DATASET],
                         min_partitions=n, **options)


def run(spark: SparkSession, entries: list[Entry], out: str, command: list[str] | None = None,
        output_file: str | None = None, hits_dir: str | None = None,
        timeout: float | None = None, ingest_dir: str | None = None,
        extra_files: Sequence[str] = (), env: Mapping[str, str] | None = None,
        compression: str | None = None, files: DataFrame | None = None,
        code_key: str = CODE_KEY, ledger: str | None = None,
        batch_records: int = LG.BATCH_RECORDS) -> dict:
    """Run the job; returns the paths written and the number of structures per outcome.

    ``files`` (dataset, structure, value) replaces the scan of the entries' folders, for
    structures that are already in a table. With ``ledger``, a folder that outlives the
    application, the command runs only on structures that no earlier attempt has finished.
    """
    t0 = time.time()
    work = scratch_path(spark, "job")
    # AG15: the number of files read is observed while the stage runs, not by a second pass.
    seen = Observation("structure_files")

    if command:
        if files is None:
            records = universe_of(spark, entries).count()
            files = structure_files(spark, entries, ingest_dir=ingest_dir)
        else:
            records = files.count()
        files = files.observe(seen, F.count(F.lit(1)).alias("files"))
        options = dict(timeout=timeout, output_file=output_file, extra_files=extra_files, env=env)
        tasks = sum(e.min_partitions for e in entries)
        if ledger:
            stage = LG.run_stage(files, command, ledger, batch_records=batch_records,
                                 records_per_task=RECORDS_PER_TASK, min_partitions=tasks, **options)
            log.info("attempts so far: %s", sorted(
                r[0] for r in stage.select("attempt").distinct().collect()))
        else:
            stage = command_stage(files, command, tasks, records, **options)
            log.info("command stage: %d partitions", stage.rdd.getNumPartitions())    # PT3
        stage.write.parquet(f"{work}/stage")          # lineage is cut here
        stage = spark.read.parquet(f"{work}/stage")
        universe = stage.select(*KEYS)
        with_output = stage.where(X.has_output("out"))
        listed = with_output.select(*KEYS)
        hits = HF.parse_hits(X.hits_from_output(with_output, KEYS), structure=F.col(STRUCTURE),
                             key=code_key)
        failures = stage.where(F.col("rc") != 0).select(*KEYS, "rc", "err")
        artefacts = stage.select(*KEYS, F.explode("files").alias("file_name", "content"))
    elif hits_dir:
        universe = universe_of(spark, entries)
        listed, raw = _hit_folders(spark, entries, hits_dir)
        hits = HF.parse_hits(raw, structure=F.col(STRUCTURE), key=code_key)
        failures = artefacts = None
    else:
        raise ValueError("give a command or a folder of hit files")

    # Hits are parsed once: hit rows and the code grain are written, everything else is derived
    # from the grain (one row per structure and code).
    SK.write_artefacts(hits, f"{out}/hits")
    hits = spark.read.schema(hits.schema).parquet(f"{out}/hits")
    S.code_grain(hits).write.parquet(f"{work}/grain")
    grain = spark.read.parquet(f"{work}/grain")
    S.rejects_from_grain(grain).write.mode("overwrite").parquet(f"{out}/rejects")
    outcome = S.outcomes(universe, S.per_structure_from_grain(grain), listed)
    SK.write_artefacts(outcome, f"{out}/structures")
    outcome = spark.read.schema(outcome.schema).parquet(f"{out}/structures")
    if failures is not None:
        failures.write.mode("overwrite").parquet(f"{out}/failures")
    if extra_files and artefacts is not None:
        SK.write_artefacts(artefacts, f"{out}/files")
    summaries = SK.parsed_summary_text(S.scored(outcome), S.accepted(grain))
    SK.write_parsed_summaries(summaries, f"{out}/parsed", compression)

    catalogue = catalogue_df(spark, entries)
    stats = S.dataset_statistics(S.scored(outcome), catalogue=catalogue)
    org, mean_col, std_col = STATISTICS_COLUMNS
    stats = stats.select(
        F.col(DATASET).alias(org), F.col("mean_score").cast("float").alias(mean_col),
        F.col("std_score").cast("float").alias(std_col))
    SK.write_single_csv(stats, out, STATISTICS_FILE)

    codes = S.code_totals(grain, outcome.where(F.col("outcome") == "hits"))
    codes.write.parquet(f"{work}/codes")
    codes = spark.read.parquet(f"{work}/codes")
    if compression:                  # SNK5: the whole summary as one compressed folder
        SK.write_csv_dir(codes, f"{out}/code_summaries", compression=compression)
    for e in entries:                                    # one small file per catalogued dataset
        SK.write_single_csv(codes.where(F.col(DATASET) == e.name).select(
            F.col(CODE).alias(CODE_SUMMARY_COLUMNS[0]),
            F.col("count").cast("int").alias(CODE_SUMMARY_COLUMNS[1])),
            out, f"{e.name}{CODE_SUMMARY_SUFFIX}")
    counts = {r["outcome"]: r["n"] for r in
              outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_files = seen.get.get("files") if command else None
    log.info("job finished in %.2f s: %s files read, outcomes %s", time.time() - t0, n_files, counts)
    return {"out": out, "outcomes": counts, "files": n_files, "seconds": time.time() - t0}


def _hit_folders(spark: SparkSession, entries: list[Entry], hits_dir: str):
    """Listing and raw rows of existing hit files: ``<hits_dir>/<dataset>/<name>_search.tsv``, or
    one flat folder where there is a single dataset."""
    listed, raw = [], []
    for e in entries:
        folder = hits_dir if len(entries) == 1 else f"{hits_dir.rstrip('/')}/{e.name}"
        listed.append(HF.list_hit_files(spark, folder).select(F.lit(e.name).alias(DATASET),
                                                              STRUCTURE))
        rows = HF.read_hit_files(spark, folder)
        raw.append(rows.select(F.lit(e.name).alias(DATASET), HF.structure_of_file(),
                               *HF.HIT_SCHEMA.names))
    return _union(listed), _union(raw)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Annotate structure files and summarise them.")
    ap.add_argument("datasets", nargs="+", help="which datasets of the catalogue to run")
    ap.add_argument("--catalogue", action="append", help="name=path[:partitions], repeatable")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--command", help="search command; {input} = structure file, {name} = its name")
    ap.add_argument("--output-file", help="file the command writes, e.g. '{name}_search.tsv'")
    ap.add_argument("--hits-dir", help="folder of existing *_search.tsv hit files")
    ap.add_argument("--extra-file", action="append", default=[],
                    help="further file of the command to publish, e.g. '{name}_segment.tsv'")
    ap.add_argument("--env", action="append", default=[], help="NAME=VALUE for the command")
    ap.add_argument("--compression", help="codec of the published summaries, e.g. gzip")
    ap.add_argument("--timeout", type=float, help="seconds per structure (none by default)")
    ap.add_argument("--ingest-dir", help="compact structure files incrementally into Parquet here")
    ap.add_argument("--ledger", help="durable folder of finished structures: a restarted job runs "
                                     "only what is not in it")
    ap.add_argument("--batch-records", type=int, default=LG.BATCH_RECORDS,
                    help="structures per commit to the ledger")
    ap.add_argument("--input-bytes", type=int,
                    help="total input size; sizes scan splits and shuffle partitions to it")
    ap.add_argument("--total-cores", type=int,
                    help="cluster cores for --input-bytes (default: the default parallelism)")
    a = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    entries = resolve(a.datasets, parse_catalogue(a.catalogue))   # raises on unknown names
    spark = build_session()
    if a.input_bytes:
        cores = a.total_cores or spark.sparkContext.defaultParallelism
        for k, v in sizing_conf(a.input_bytes, cores).items():
            spark.conf.set(k, v)   # runtime SQL settings: they apply to the jobs that follow
    try:
        run(spark, entries, a.out.rstrip("/"), shlex.split(a.command) if a.command else None,
            a.output_file, a.hits_dir, a.timeout, a.ingest_dir, a.extra_file,
            dict(x.split("=", 1) for x in a.env), a.compression,
            ledger=a.ledger and a.ledger.rstrip("/"), batch_records=a.batch_records)
    except Exception:
        log.exception("job failed")
        raise
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
