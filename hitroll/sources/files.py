"""Whole-file sources (SRC1-SRC5, SRC7, PRJ1, SC1, SC14).

A structure file is one record. Spark's file sources keep a status per file on the driver and cut
scans into a task per few files, so millions of files outgrow both. Here folders are listed by tasks,
level by level, into a table (:mod:`hitroll.sources.listing`), and tasks read the files of its rows;
the driver holds folders. Rows, hidden files, globs and partition columns are those of Spark's
sources, which still read what Arrow cannot open and paths that name single files. Files are dealt to
tasks by number and bytes, not by work, so an expensive per-record stage states its least number of
tasks (``operators.external.run_command``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.functions.columns import MEAN_MARKER, py_float
from hitroll.sources import listing as LS


def _meta(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_name").alias("file_name"), *keep)


def read_texts(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """SRC1 (+ SRC3 glob, SRC4 gzip): one row per file, ``(path, file_name, value, <partition
    columns>)``. ``.gz`` files are decompressed transparently. Zero-byte files are not returned
    (R8). ``recursive``: from all subfolders, without partition columns."""
    found = LS.find(spark, path, glob, recursive)
    if found is not None and found.readable:
        texts = LS.contents(found.files.where("length > 0"), found.tasks(), unpack=True)
        return texts.select(F.col("uri").alias("path"), F.col("uri_name").alias("file_name"),
                            F.col("content").cast("string").alias("value"), *found.parts)
    r = spark.read.format("text").option("wholetext", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.load(path)
    return _meta(df, [c for c in df.columns])


def strip_final_newline(c: str = "value"):
    """Spark's text writer ends every record with a newline; drop exactly one."""
    col = F.col(c)
    return F.when(col.endswith("\n"), F.expr(f"substring({c}, 1, length({c}) - 1)")).otherwise(col)


def read_binary(spark: SparkSession, path: str, glob: str | None = None,
                with_content: bool = True) -> DataFrame:
    """SRC2: ``(path, file_name, length, [content], <partition columns>)``.

    Without ``with_content`` this is a pure listing: no file is opened. Gzip is *not* decompressed
    here.
    """
    found = LS.find(spark, path, glob)
    if found is not None:
        files = found.files.where("length > 0")
        if with_content:
            files = LS.contents(files, found.tasks(), unpack=False)
        return files.select("path", F.col("name").alias("file_name"), "length",
                            *(["content"] if with_content else []), *found.parts)
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    parts = [c for c in df.columns if c not in ("path", "modificationTime", "length", "content")]
    cols = ["length"] + (["content"] if with_content else []) + parts
    return df.select(F.col("path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
                     *cols)


def decode_utf8(c: str = "content"):
    """SC14: bytes to text."""
    return F.decode(F.col(c), "UTF-8")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(file_path, file_name, length)`` of every file, zero-byte ones too, without opening any.
    ``file_path`` is spelled as in the text scans (``_metadata``). Where Spark's sources list, they
    leave files without bytes out, so those are taken from the scan's file index."""
    found = LS.find(spark, path, glob, recursive=True)
    if found is not None:
        return found.files.select(F.col("uri").alias("file_path"), F.col("uri_name").alias("file_name"), "length")
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    listed = df.select(F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.file_name").alias("file_name"), "length")
    index = df._jdf.inputFiles()             # stays in the JVM: one call a file would be slow
    if len(index) == listed.count():
        return listed
    # The index writes file:///x where the metadata column has file:/x.
    plain = F.regexp_replace("file_path", r"^([A-Za-z0-9+.-]+):/+", "$1:/").alias("file_path")
    jvm = spark._jvm
    every = DataFrame(spark._jsparkSession.createDataset(
        jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(index), jvm.org.apache.spark.sql.Encoders.STRING())
        .toDF(), spark).toDF("file_path").select(plain)
    empty = every.join(listed.select(plain), "file_path", "left_anti").select(
        "file_path", F.regexp_extract("file_path", r"([^/]*)$", 1).alias("file_name"),
        F.lit(0).cast("long").alias("length"))
    return listed.unionByName(empty)


def new_files(listing: DataFrame, ingested: DataFrame, key: str = "file_name") -> DataFrame:
    """SRC5 / JN2: files not yet ingested (``left_anti`` on the name)."""
    return listing.join(ingested.select(key).distinct(), key, "left_anti")


def structure_texts(spark: SparkSession, path: str, plain: str, packed: str) -> DataFrame:
    """SRC1 + SRC3 + SRC4: ``(structure, value)``, one row per structure file under ``path``.

    A structure is a file of glob ``plain``, or one of glob ``packed`` (its name without ``.gz``)
    where the plain file is absent: the unpacked file wins. Files without bytes, which the text
    scan leaves out, are taken from the listing with an empty value. Every file is opened once.
    """
    name = lambda c: F.regexp_replace(F.col(c), r"\.gz$", "").alias("structure")
    listed = list_files(spark, path, plain)
    here = listed.select(name("file_name")).distinct()

    def texts(glob: str) -> DataFrame:
        empty = list_files(spark, path, glob).where(F.col("length") == 0)
        return (read_texts(spark, path, glob, recursive=True).select("file_name", "value")
                .unionByName(empty.select("file_name", F.lit("").alias("value")))
                .select(name("file_name"), "value"))
    return texts(plain).unionByName(texts(packed).join(here, "structure", "left_anti"))


def structure_names(spark: SparkSession, path: str, plain: str, packed: str) -> DataFrame:
    """``(structure)``: the same universe from listings alone."""
    both = list_files(spark, path, plain).unionByName(list_files(spark, path, packed))
    return both.select(F.regexp_replace("file_name", r"\.gz$", "").alias("structure")).distinct()


def parse_parsed_summary(texts: DataFrame, file_col: str = "file_name",
                         keep: list | tuple = ()) -> DataFrame:
    """SRC7 + PRJ4 + PRJ5 + FLT2 + FLT3: read the parsed-summary text format back. Without a
    column ``file_col``, the structure's name is taken from the first line.

    Returns ``(<file_col>, mean_score, entries)`` where ``entries`` is an array of
    ``struct(code, n)``. Line 1 holds the mean after the marker (0.0 when the marker is absent);
    lines from the third on are ``code,count``; blank lines are ignored. The last comma splits a
    line, so codes containing commas survive (R10 fixed). An unparseable count gives NULL.
    """
    lines = F.split(F.col("value"), "\n")
    first = F.element_at(lines, 1)
    after = F.element_at(F.split(first, MEAN_MARKER, 2), 2)
    mean = F.when(first.contains(MEAN_MARKER), py_float(after)).otherwise(F.lit(0.0))
    body = F.filter(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))),
                    lambda x: F.trim(x) != "")
    if file_col not in texts.columns:
        name = F.regexp_extract(first, rf"^#(.*) Results\. {MEAN_MARKER}", 1)
        texts = texts.withColumn(file_col, name)
    entries = F.transform(body, lambda x: F.struct(
        F.regexp_extract(F.trim(x), r"^(.*),([^,]*)$", 1).alias("code"),
        F.regexp_extract(F.trim(x), r"^(.*),([^,]*)$", 2).try_cast("int").alias("n")))
    return texts.select(*keep, file_col, mean.alias("mean_score"), entries.alias("entries"))


def entries_to_map(entries):
    """Entries as ``map<code, n>`` with the last duplicate winning, as a dict assignment does."""
    def keep(x, i):
        later = F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0)))
        return ~F.exists(later, lambda y: y["code"] == x["code"])
    return F.map_from_entries(F.filter(entries, keep))
