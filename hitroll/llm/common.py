"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.session import scratch_path

WHITE_SPACE = " \t\n\x0b\x0c\r"
NOT_WHITE = r"[^\x20\x09-\x0D]"
WHITE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage ends at files that
    every executor can reach, so a lost executor costs only its running tasks."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`cut` wrote, once nothing that is still to run reads them; and let
    Spark drop the shuffle files of finished steps, which it does when the driver's garbage
    collection finds them unused."""
    for df in tables:
        spark, path = df.sparkSession, df._cut_path
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    gc.collect()
    spark._jvm.System.gc()


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that on pure ASCII and is much faster there."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, UPPER.lower())))


def lines_of(text: Column) -> Column:
    """Lines split at \\n; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def words_of(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space; null is no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE, -1), lambda w: w != F.lit(""))


def tuck(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with the columns ``own``, all others in one struct ``__extra``: whatever they are
    called, they cannot clash with an operator's working columns (which start with ``__``)."""
    extra = [docs[f"`{c}`"] for c in docs.columns if c not in own]
    kept = [docs[f"`{c}`"] for c in own]
    return docs.select(*kept, F.struct(*extra).alias("__extra")) if extra else docs.select(*kept)


def untuck(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, in its order, from a frame that came out of :func:`tuck`."""
    there = set(df.columns)
    extra = set(df.schema["__extra"].dataType.names) if "__extra" in there else set()
    return df.select(*[(F.col("__extra").getField(c) if c in extra else F.col(f"`{c}`")).alias(c)
                       for c in like.columns])
