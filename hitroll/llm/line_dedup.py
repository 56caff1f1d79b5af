"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; lines are
identified by the key's MD5. :class:`LineRuns` holds, per key, in how many documents it occurs
and the largest ``doc_id`` among them, as runs bucketed and sorted by hash. A new batch is first
aggregated, then merge-anti-joined with the keys the runs hold: unseen keys enter the batch's own
run as new, known ones as increments. When a level has ``fan_in`` runs, they are merged into one
run of the next level, so a key is rewritten once per level and a batch reads O(log batches) runs.

Defined results: null or empty text is one empty line; null ``doc_id`` counts as smaller than any
other; repeated rows each count as a document, and all rows of the largest ``doc_id`` keep the
line; ties cannot occur otherwise; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.llm.common import WHITE_SPACE, cut, lines_of, lower_ascii, tuck, untuck
from hitroll.session import scratch_path

MIN_CHARS = 40
MIN_DOCS = 5


class LineRuns:
    """Levelled store of line hashes; every run is a table bucketed and sorted by ``h``, so that
    a merge join reads it without a shuffle or a sort."""

    COLUMNS = ("h", "n_docs", "max_doc", "is_new")

    def __init__(self, spark: SparkSession, fan_in: int = 4, buckets: int | None = None):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, df: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch_path(self.spark, name)
        (df.select(*self.COLUMNS).repartition(self.buckets, "h").write
         .bucketBy(self.buckets, "h").sortBy("h")
         .option("path", self.paths[name]).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def runs(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of line rows ``(h, first, doc_id)``; ``first`` marks the first line with
        that key in its document."""
        batch = lines.groupBy("h").agg(F.sum(F.col("first").cast("long")).alias("n_docs"),
                                       F.max("doc_id").alias("max_doc"))
        batch = cut(batch, "line-batch")
        fresh = batch
        for run in self.runs():             # one merge anti-join per run, each read in its buckets
            fresh = fresh.join(self.spark.table(run).where("is_new").select("h"), "h", "left_anti")
        fresh = cut(fresh.select("h", F.lit(True).alias("fresh")), "line-fresh")
        own = (batch.join(fresh, "h", "left")
               .withColumn("is_new", F.col("fresh").isNotNull()).drop("fresh"))
        self._write(own, 0)
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        names = self.levels[level]
        merged = self._totals(names).withColumn("is_new", F.lit(True))
        # A key's first sight may lie in an older level; there it is already marked new.
        for up in self.levels[level + 1:]:
            for n in up:
                older = (self.spark.table(n).where("is_new")
                         .select("h", F.lit(True).alias("old")))
                merged = (merged.join(older, "h", "left")
                          .withColumn("is_new", F.col("is_new") & F.col("old").isNull())
                          .drop("old"))
        self.levels[level] = []
        self._write(merged, level + 1)
        for n in names:
            self.spark.sql(f"DROP TABLE {n}")

    def _totals(self, names: list[str]) -> DataFrame:
        # Read as plain files: a union of bucketed tables would be taken to be partitioned by h,
        # although its scans may be planned without their buckets, and keys would not meet.
        rows = (self.spark.read.schema(self.spark.table(names[0]).schema)
                .parquet(*[self.paths[n] for n in names]))
        return rows.groupBy("h").agg(F.sum("n_docs").alias("n_docs"),
                                     F.max("max_doc").alias("max_doc"))

    def totals(self) -> DataFrame:
        """One row per key over all batches so far: ``h, n_docs, max_doc``."""
        return self._totals(self.runs())


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, th, h, pos, first`` per line whose key has at least ``min_chars`` code points.
    ``th`` tells rows of one ``doc_id`` with different texts apart."""
    trimmed = F.transform(lines_of(F.col("text")), lambda line, i: F.struct(
        F.btrim(line, F.lit(WHITE_SPACE)).alias("t"), i.alias("pos")))
    hashed = F.transform(F.filter(trimmed, lambda x: F.char_length(x["t"]) >= min_chars),
                         lambda x: F.struct(F.unhex(F.md5(lower_ascii(x["t"]))).alias("h"),
                                            x["pos"].alias("pos")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.array_sort(hashed).alias("s"))
    flagged = F.transform("s", lambda x, j: F.struct(
        x["h"].alias("h"), x["pos"].alias("pos"),
        ((j == 0) | (F.get("s", j - 1)["h"] != x["h"])).alias("first")))
    return rows.select("doc_id", "th", F.inline(flagged))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                  batches: int = 4) -> DataFrame:
    """``doc_id, th, dropped`` (positions of the lines to drop) for documents that lose lines."""
    spark = docs.sparkSession
    rows = cut(line_rows(docs, min_chars)
               .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")),
               "line-rows", partition_by="batch")
    store = LineRuns(spark)
    for b in range(batches):
        store.add(rows.where(F.col("batch") == b))
    common = store.totals().where(F.col("n_docs") >= min_docs)
    hits = rows.join(common, "h").where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
    return hits.groupBy("doc_id", "th").agg(F.array_distinct(F.collect_list("pos")).alias("dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                batches: int = 4) -> DataFrame:
    """All columns of ``docs`` with the kept text in ``text``, and ``__n_lines``, ``__n_dropped``."""
    drops = (dropped_lines(docs, min_docs, min_chars, batches)
             .select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"),
                     F.col("dropped").alias("__dropped")))
    wide = docs.join(drops, docs["doc_id"].eqNullSafe(F.col("__id"))
                     & (F.xxhash64(docs["text"]) == F.col("__th")), "left")
    wide = wide.withColumn("__lines", lines_of(F.col("text")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    return (wide.withColumn("__n_lines", F.size("__lines").cast("long"))
            .withColumn("__n_dropped", F.coalesce(F.size("__dropped"), F.lit(0)).cast("long"))
            .withColumn("text", F.when(F.col("__dropped").isNull(),
                                       F.coalesce("text", F.lit("")))
                        .otherwise(F.array_join(F.transform(
                            kept, lambda i: F.get("__lines", i)), "\n")))
            .drop("__lines", "__id", "__th", "__dropped"))


def without_common_lines(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the kept lines as text; ``n_chars``, where there is one, follows."""
    kept = dedup_lines(tuck(docs, "doc_id", "text"), **settings)
    out = untuck(kept, docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT rid, doc_id, line, pos,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT rid) >= 5),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.last AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
