"""Hit files: tab-separated, one header line, fields read by position (SRC6, PRJ2, PRJ3, PRJ7).

Field 3 is the score, field 15 the JSON metadata cell; the others are not used. A row that
would make the reference parser raise is kept and marked ``bad`` with a ``reason``, so the whole
structure can be rejected as a unit (R7) and the reasons reported.

Reading is a plain CSV scan with a fixed all-string schema: Spark splits the listing over
tasks, prunes unused fields, and attaches the file through ``_metadata`` (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitroll.functions.columns import (CODE_KEY, HIT_FILE_SUFFIX, R_JSON, R_KEY, R_NESTED, basename,
                                       py_float, structure_id, with_json_check)
from hitroll.schema import BAD, CODE, DATASET, REASON, SCORE, STRUCTURE

from hitroll.fixed import HIT_FIELDS as N_FIELDS
from hitroll.fixed import META_FIELD, SCORE_FIELD
HIT_SCHEMA = T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(N_FIELDS)])
HIT_DDL = ", ".join(f"c{i} string" for i in range(N_FIELDS))

# Reasons a hit row is rejected, tested in this order (then the JSON reasons).
R_MISSING, R_SCORE = "missing_field", "bad_score"
REASONS = (R_MISSING, R_SCORE, R_JSON, R_KEY, R_NESTED)


def hit_reader(spark: SparkSession, multiline: bool = True):
    """CSV reader of tab-separated hit files, one header line each.

    Quoting: double quote, doubled to escape (R11), hence ``escape='"'``. Blank lines are
    skipped by Spark (R12); ``scan_records`` keeps them. A quoted cell may span lines, at the price of
    reading each file in one task, which suits files of one structure; ``multiline=False`` lets
    a big table without such cells be split.
    """
    return (spark.read.schema(HIT_SCHEMA)
            .option("sep", "\t").option("header", True)
            .option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1)
            .option("mode", "PERMISSIVE").option("multiLine", multiline))


def read_hit_files(spark: SparkSession, path: str, glob: str | None = f"*{HIT_FILE_SUFFIX}",
                   multiline: bool = True) -> DataFrame:
    """Raw hit rows with ``file_path`` and ``file_name`` of the file they came from, and the
    folder's partition columns (``dataset=...``), if any, as text."""
    r = hit_reader(spark, multiline)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.csv(path)
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_name").alias("file_name"))


def scan_records(spark: SparkSession, path: str, glob: str | None = f"*{HIT_FILE_SUFFIX}") -> DataFrame:
    """Every record of the hit files at its place, blank ones too (R12): the columns of
    ``read_hit_files`` and ``record``, from 1. A blank record has no fields, so ``parse_hits``
    marks it bad and its structure is rejected. Line ends may be any of the three; the first line
    is the header whatever it holds; a last line needs no end.

    The text of a file is one value here, at most 2 GB, which suits files of one structure. Of the
    pieces between quotes, every second one lies within a quoted cell, where line ends are set
    aside until the records are cut. (So a lone quote inside an unquoted cell opens a quoted part
    here; the reference takes it as a letter.)"""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.text(path, wholetext=True).select("*", F.col("_metadata.file_path").alias("file_path"),
                                F.col("_metadata.file_name").alias("file_name"))
    mark = "\u0001"                                # set aside: mark + n; the mark itself: mark + b
    text = F.replace(F.regexp_replace("value", "\r\n?", "\n"), F.lit(mark), F.lit(mark + "b"))
    head = F.instr(text, "\n")
    body = F.when(head > 0, F.substr(text, head + 1)).otherwise("")
    kept = F.transform(F.split(body, '"', -1), lambda piece, k: F.when(
        k % 2 == 1, F.replace(piece, F.lit("\n"), F.lit(mark + "n"))).otherwise(piece))
    extra = [c for c in files.columns if c != "value"]
    cut_at = files.select(*extra, F.array_join(kept, '"').alias("_text")).where("_text <> ''")
    rows = cut_at.select(*extra, F.posexplode(F.split(F.regexp_replace("_text", r"\n\z", ""), "\n", -1))
                         .alias("_place", "_record"))
    record = F.replace(F.replace("_record", F.lit(mark + "n"), F.lit("\n")),
                       F.lit(mark + "b"), F.lit(mark))
    fields = F.from_csv(record, HIT_DDL, {"sep": "\t", "quote": '"', "escape": '"',
                                          "maxCharsPerColumn": "-1"})
    return (rows.select(*extra, (F.col("_place") + 1).cast("long").alias("record"),
                        fields.alias("_fields"))
            .select("_fields.*", *extra, "record"))


def parse_hits(raw: DataFrame, structure: Column | None = None, key: str = CODE_KEY) -> DataFrame:
    """Typed hit rows: (structure, score, code, bad, reason) plus any partition columns.

    ``structure`` defaults to the file name with the ``_search.tsv`` suffix removed (R16).
    The score and the JSON cell are each parsed once (staged columns), then the reason, code
    and flag are read from those columns.
    """
    sc, meta = f"c{SCORE_FIELD}", f"c{META_FIELD}"
    sid = structure if structure is not None else structure_id(F.col("file_name"))
    extra = [c for c in raw.columns
             if not (c.startswith("c") and c[1:].isdigit())
             and c not in ("file_path", "file_name", STRUCTURE, SCORE, CODE, BAD, REASON)]
    staged = raw.select(*extra, sid.alias(STRUCTURE), F.col(sc).alias("_sc"),
                        F.col(meta).alias("_meta"), py_float(F.col(sc)).alias(SCORE))
    staged = with_json_check(staged, "_meta", key, code_col="_code", reason_col="_jr")
    reason = (F.when(F.col("_sc").isNull() | F.col("_meta").isNull(), F.lit(R_MISSING))
               .when(F.col(SCORE).isNull(), F.lit(R_SCORE))
               .otherwise(F.col("_jr")))
    staged = staged.withColumn(REASON, reason)
    return staged.select(*extra, STRUCTURE, SCORE,
                         F.when(F.col(REASON).isNull(), F.col("_code")).alias(CODE),
                         F.col(REASON).isNotNull().alias(BAD), REASON)


def structure_of_file() -> Column:
    """PRJ7: the structure that a hit row's file belongs to."""
    return structure_id(F.col("file_name")).alias(STRUCTURE)


def list_hit_files(spark: SparkSession, path: str, glob: str = f"*{HIT_FILE_SUFFIX}") -> DataFrame:
    """Listing of hit files (path, length, structure) without reading their content.

    The binaryFile source only reads ``content`` when it is selected. Zero-byte files are left
    out: the reference parser fails on them (R8), so they mean "no output".
    """
    ls = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
          .select("path", "length"))
    return (ls.where(F.col("length") > 0)
            .select("path", "length", structure_id(basename(F.col("path"))).alias(STRUCTURE)))


def rejects(hits: DataFrame) -> DataFrame:
    """Rejected structures with the number of bad rows and the distinct reasons (FLT6)."""
    keys = [DATASET, STRUCTURE] if DATASET in hits.columns else [STRUCTURE]
    return (hits.groupBy(*keys)
            .agg(F.sum(F.col(BAD).cast("long")).alias("n_bad"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.array_sort(F.collect_set(REASON)).alias("reasons"))
            .where(F.col("n_bad") > 0))
