"""Small fixtures shared by the operator tests: nulls, empty and long texts, repeated rows,
empty tables, and extra columns whose names clash with working columns."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, source="s"):
    """Rows ``(doc_id, text)`` or texts alone, with clashing extra columns."""
    rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    rows = [(i, t, "en", source if isinstance(source, str) else source(i), len(t or ""))
            for i, t in rows]
    df = spark.createDataFrame(rows, DOCS)
    return (df.withColumn("__lines", F.lit(1)).withColumn("h", F.lit("x"))
            .withColumn("n", F.lit(2.5)).withColumn("__id", F.lit("y"))
            .withColumn("component", F.lit(3)))


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def save(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
