"""Incremental ingest of structure files (SRC5): process only files not seen before.

The reference re-checks every target on each run ("decompress unless the output exists").
Here every run lists the folder by tasks and appends the files that no earlier run has listed to a
table of arrivals (Parquet, in the checkpoint folder). A Structured Streaming query does the rest of
the bookkeeping: it reads that table, whose few files its checkpoint records, the ``availableNow``
trigger processes everything new and stops, and the file sink's metadata log makes each run
exactly-once, also when executors are lost mid-run. (A file source right on the structure files
keeps every name on the driver, lists each new file as a folder of its own and cuts a task per few
files.) Arrivals that a dead run has listed but not ingested are ingested by the next one.
A file counts as new by its name alone, whatever its date, and after each run the listing is
compared with the table, so a file that was missed raises instead of being lost.
The result is a Parquet table ``(path, file_name, value, <partition columns>, run)``; turning
many small files into one columnar table also removes the small-file cost from later scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitroll.sources import listing as LS
from hitroll.sources.files import list_files, new_files

# Lifts the file source's limit (7 days by default) on a new file's age relative to the newest.
ANY_AGE = "36500d"


def ingest_texts(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str,
                 schema: str = "value string", glob: str | None = None, run_tag=None,
                 max_files_per_trigger: int | None = None) -> None:
    """Append every not-yet-ingested file under ``source_dir`` to ``table_path``.

    ``schema`` must start with ``value string`` and may add partition columns of the source
    folder (``<key>=<value>`` directories). ``run_tag`` is stored in column ``run`` so callers can
    see which run picked a file up. Blocks until the available files are committed.
    """
    given = StructType.fromDDL(schema)
    found = LS.find(spark, source_dir, glob, types={f.name: f.dataType for f in given.fields[1:]})
    arrivals = f"{checkpoint.rstrip('/')}/arrivals"
    older = found is not None and not _there(spark, arrivals) and _there(spark, f"{checkpoint.rstrip('/')}/sources")
    if found is not None and found.readable and not older:
        s = _arrived(spark, found, arrivals, given, max_files_per_trigger)
    else:
        s = _streamed(spark, source_dir, schema, glob, max_files_per_trigger)
    q = (s.withColumn("run", F.lit(run_tag)).writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .option("path", table_path).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    listing = list_files(spark, source_dir, glob).where("length > 0")
    missed = new_files(listing, spark.read.parquet(table_path).select(F.col("path").alias("file_path")),
                       key="file_path").limit(5).collect()
    if missed:
        raise RuntimeError(f"not ingested: {[r['file_path'] for r in missed]}")


def _there(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _arrived(spark: SparkSession, found: LS.Found, arrivals: str, given: StructType,
             most: int | None) -> DataFrame:
    """Stream of the texts of ``arrivals``, to which files that are new are added first."""
    extra = [f"`{f.name}`" for f in given.fields[1:]]
    extra += [c for c in found.parts if c not in extra]
    columns = ["root", "name", "path", "uri", "uri_name", "length", *extra]
    new = found.files.where("length > 0")
    if extra:
        absent = [c for c in extra if c not in found.parts]
        new = new.withColumns({c.strip("`"): F.lit(None).cast(given[c.strip("`")].dataType) for c in absent})
    new = new.select(*columns)
    if _there(spark, arrivals):
        new = new_files(new, spark.read.schema(new.schema).parquet(arrivals), key="path")
    new = new.select(*columns)
    w = new.write.mode("append")
    if most:
        w = w.option("maxRecordsPerFile", most)
    w.parquet(arrivals)
    r = spark.readStream.schema(new.schema).option("maxFileAge", ANY_AGE)
    if most:                                     # each of them holds that many files at most
        r = r.option("maxFilesPerTrigger", 1)
    s = LS.contents(r.parquet(arrivals), found.tasks(), unpack=True)
    return s.select(F.col("uri").alias("path"), F.col("uri_name").alias("file_name"),
                    F.col("content").cast("string").alias("value"), *extra)


def _streamed(spark: SparkSession, source_dir: str, schema: str, glob: str | None, most: int | None) -> DataFrame:
    """Stream right from the structure files: where only Spark's own source can read them, or where
    the checkpoint is of such a stream, which cannot go on with another source."""
    r = (spark.readStream.format("text").option("wholetext", True).option("maxFileAge", ANY_AGE)
         .schema(schema))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if most:
        r = r.option("maxFilesPerTrigger", most)
    s = r.load(source_dir)
    extra = [c for c in s.columns if c != "value"]
    return s.select(F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_name").alias("file_name"), "value", *extra)
