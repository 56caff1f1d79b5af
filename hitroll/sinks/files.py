"""Writers (SNK1-SNK5).

All writes go through Spark's commit protocol, so a retried task cannot publish twice and a
rerun replaces the previous result (R17 fixed: the reference kept the old file).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.fixed import MEAN_MARKER, SUMMARY_SECOND_LINE
from hitroll.session import classic_context
from hitroll.schema import CODE, DATASET, STRUCTURE
from hitroll.sinks.texts import write_text_files

TSV_OPTIONS = {"sep": "\t", "header": "true", "quote": '"', "escape": '"'}


def write_csv_dir(df: DataFrame, path: str, compression: str | None = None) -> None:
    """SNK2 (+ SNK5 with ``compression='gzip'``): header CSV folder, overwritten."""
    w = df.write.mode("overwrite").option("header", True)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_single_csv(df: DataFrame, folder: str, name: str) -> str:
    """SNK1: one header CSV named exactly ``<folder>/<name>.csv``.

    Meant for the small final tables only (one task writes it). The part file is renamed over
    an existing target in one step, so a reader sees the old file or the new one. Returns the
    final path.
    """
    spark = df.sparkSession
    folder = folder.rstrip("/")
    if classic_context(spark) is None:
        # Spark Connect has no access to the Hadoop FileSystem API: keep the folder form.
        target = f"{folder}/{name}.csv"
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(target)
        return target
    tmp = f"{folder}/_tmp_{name}_{uuid.uuid4().hex[:8]}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp)
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    src_dir = Path(tmp)
    fs = src_dir.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(src_dir)
             if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {tmp}, found {len(parts)}")
    target = Path(f"{folder}/{name}.csv")
    hadoop = jvm.org.apache.hadoop.fs
    kinds = getattr(hadoop, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kinds, 1)
    over[0] = kinds.OVERWRITE
    qualified = [fs.makeQualified(p) for p in (parts[0], target)]
    hadoop.FileContext.getFileContext(qualified[1].toUri(), conf).rename(*qualified, over)
    fs.delete(src_dir, True)
    return target.toString()


def _parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_hit_files(rows: DataFrame, path: str, by: list[str], key: str | None = None,
                    rows_per_file: int = 1_000_000, max_hot: int = 2_000_000) -> None:
    """Hit files in folders ``by`` (partition columns), tab-separated with a header.

    ``rows`` carries the 16 string fields c0..c15 plus ``by``. Rows are hash-partitioned on
    ``by`` + ``key`` (the structure) so each structure is written by one task; the partition
    count is left to AQE, which merges small partitions so that few files are written per
    folder. A structure with more than ``rows_per_file`` rows is spread over
    ``ceil(rows / rows_per_file)`` tasks (several files, each with its header), so no task
    receives an unbounded group. The list of such hot structures has at most
    ``total / rows_per_file`` entries; it is broadcast only after checking that it has at most
    ``max_hot`` entries, and joined by shuffle otherwise.
    """
    keys = list(by) + ([key] if key else [])
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = (counts.where(F.col("_n") > rows_per_file)
           .select(*keys, F.ceil(F.col("_n") / rows_per_file).cast("int").alias("_k")))
    hot_stats = hot.agg(F.count(F.lit(1)).alias("n"), F.sum("_k").alias("salts")).first()
    n_hot = hot_stats["n"]
    if n_hot:
        side = F.broadcast(hot) if n_hot <= max_hot else hot
        # A number per row, not a hash of its content: equal rows must not share one salt.
        numbered = rows.withColumn("_row", F.monotonically_increasing_id())
        salted = (numbered.join(side, keys, "left")
                  .withColumn("_salt", F.pmod("_row", F.coalesce(F.col("_k"), F.lit(1))))
                  .drop("_k", "_row"))
        # An explicit count keeps AQE from merging the hot structure's pieces back together.
        n = max(_parallelism(rows.sparkSession), int(hot_stats["salts"]))
        rows = salted.repartition(n, *keys, "_salt").drop("_salt")
    else:
        rows = rows.repartition(*keys)
    w = rows.write.mode("overwrite").partitionBy(*by)
    for k, v in TSV_OPTIONS.items():
        w = w.option(k, v)
    w.csv(path)


def _one_file_each(df: DataFrame, key: str, path: str, compression: str | None, mode: str,
                   by: tuple = ()) -> None:
    """One text file per row of ``df`` (key, value, *by), in a folder per task (and ``by``): one per
    record would put the complete listing into the file index; a folder column that holds ids
    would have them read back as numbers."""
    n = _parallelism(df.sparkSession)
    write_text_files(df.repartition(n, key).select("value", *[F.col(c).cast("string") for c in by]),
                     path, compression, mode)


def write_structure_texts(docs: DataFrame, path: str, key: str, text: str,
                          compression: str | None = None, mode: str = "overwrite") -> None:
    """One text file per structure (the input shape of SRC1): its id in the first line, then the
    text. One row per structure, so hash partitioning on the key cannot skew."""
    body = F.concat(F.col(key).cast("string"), F.lit("\n"), F.coalesce(F.col(text), F.lit("")))
    _one_file_each(docs.select(key, body.alias("value")), key, path, compression, mode)


def write_artefacts(df: DataFrame, path: str, by: str = "dataset") -> None:
    """SNK3: per-structure results, hits or output files as Parquet partitioned by dataset."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def parsed_summary_text(per: DataFrame, counts: DataFrame, file_col: str = STRUCTURE) -> DataFrame:
    """SNK4: the parsed-summary text of each structure, as the reference's parser writes it.

    ``per``: (structure, n_hits, mean_score); ``counts``: (structure, code, n). Line 1 is
    ``#<file> Results. mean plddt: <mean>`` (``0`` when there are no hits), line 2
    ``cath_id,count``, then one ``code,n`` line per code. The code list of one structure is
    bounded by the code vocabulary, not by the number of hits.
    """
    keys = [c for c in (DATASET, STRUCTURE) if c in per.columns and c in counts.columns]
    lines = (counts.groupBy(*keys)
             .agg(F.array_join(F.transform(
                 F.array_sort(F.collect_list(F.struct(CODE, "n"))),
                 lambda x: F.concat(x[CODE], F.lit(","), x["n"].cast("string"))), "\n")
                  .alias("body")))
    mean_txt = F.when(F.col("n_hits") > 0, F.col("mean_score").cast("string")).otherwise(F.lit("0"))
    header = F.concat(F.lit("#"), F.col(file_col).cast("string"), F.lit(f" Results. {MEAN_MARKER} "),
                      mean_txt)
    return (per.join(lines, keys, "left")
            .select(*keys, F.concat_ws("\n", header, F.lit(SUMMARY_SECOND_LINE),
                                           F.col("body")).alias("value")))


def write_parsed_summaries(text_df: DataFrame, path: str, compression: str | None = None) -> None:
    """One ``.parsed``-style text file per structure (one row each, so no skew), by dataset where
    there is one; the structure's name is in the first line."""
    by = tuple(c for c in (DATASET,) if c in text_df.columns)
    _one_file_each(text_df.select(F.col(STRUCTURE).alias("_key"), "value", *by), "_key", path,
                   compression, "overwrite", by)
