"""Adapters from the given tables to the canonical roles (FIXTURES.md, "Stand-ins").

The test data holds no structure files, so each role is played by a table with the same shape:

* structure universe: ``orders`` (structure = o_orderkey, dataset = o_orderpriority)
* hits: ``lineitem`` (structure = l_orderkey, score = l_quantity,
  code = l_returnflag || '.' || l_linestatus)
* hits with JSON metadata: ``events`` (dataset = event_type, structure = user_id, so that
  datasets share structure names; score = value, code = key ``k`` of ``props``), with some cells
  damaged by a rule on ``event_id``
* structure texts: ``documents`` (doc_id, text)
* labelled vectors: ``embeddings`` (vec_id, embedding, label)

Only the columns a role needs are selected, so the parquet scan reads just those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.schema import BAD, CODE, DATASET, SCORE, STRUCTURE
from hitroll.sources.hits import HIT_SCHEMA, parse_hits

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(STRUCTURE), F.col("o_orderpriority").alias(DATASET))


def lineitem_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(STRUCTURE),
        F.col("l_quantity").alias(SCORE),
        F.concat_ws(".", "l_returnflag", "l_linestatus").alias(CODE))


# Fixed rule of the stand-in: which cell of an event is damaged, by event_id modulo DAMAGE_EVERY.
DAMAGE_EVERY = 211
DAMAGE = {0: "bad_score", 1: "bad_json", 2: "missing_key", 3: "nested_value", 4: "missing_field",
          5: "null_code", 6: "comma_code", 7: "line_end_in_note"}

#: The same rule in SQL: relation ``h`` (dataset, user_id, event_id, value, reason, code).
EVENT_HITS_SQL = f"""
h AS (
  SELECT event_type AS dataset, user_id, event_id, value,
         CASE event_id % {DAMAGE_EVERY} WHEN 0 THEN 'bad_score' WHEN 1 THEN 'bad_json'
              WHEN 2 THEN 'missing_key' WHEN 3 THEN 'nested_value' WHEN 4 THEN 'missing_field'
              ELSE CASE WHEN value IS NULL OR props IS NULL THEN 'missing_field'
                        WHEN NOT json_valid(props) THEN 'bad_json'
                        WHEN json_extract(props, '$.k') IS NULL THEN 'missing_key' END
         END AS reason,
         CASE event_id % {DAMAGE_EVERY} WHEN 5 THEN 'None' WHEN 6 THEN 'a,b'
              ELSE json_extract_string(props, '$.k') END AS code
  FROM events)"""


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text cells ``dataset, user_id, event_id, score, note, meta``, damaged by rule."""
    ev = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", "value", "props")
    kinds = F.create_map(*[F.lit(x) for k, name in DAMAGE.items() for x in (k, name)])
    kind = F.element_at(kinds, (F.col("event_id") % DAMAGE_EVERY).cast("int"))
    ev = ev.withColumn("_kind", kind)
    meta = (F.when(F.col("_kind") == "bad_json", "{").when(F.col("_kind") == "missing_key", "{}")
            .when(F.col("_kind") == "nested_value", '{"k": {"q": 1}}')
            .when(F.col("_kind") == "missing_field", F.lit(None))
            .when(F.col("_kind") == "null_code", '{"k": null}')
            .when(F.col("_kind") == "comma_code", '{"k": "a,b"}').otherwise(F.col("props")))
    return ev.select(
        F.col("event_type").alias(DATASET), "user_id", "event_id",
        F.when(F.col("_kind") == "bad_score", "9o").otherwise(F.col("value").cast("string"))
        .alias("score_text"),
        F.when(F.col("_kind") == "line_end_in_note", "two\nlines").alias("note"),
        meta.alias("meta"))


def event_hit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those events in the 16-field hit layout plus the dataset: field 0 is the structure, field 3
    the score text, field 5 a note that may hold a line end, field 15 the JSON cell."""
    fields = {0: F.col("user_id").cast("string"), 1: F.col("event_id").cast("string"),
              3: F.col("score_text"), 5: F.col("note"), 15: F.col("meta")}
    cols = [fields.get(i, F.lit(None).cast("string")).alias(c)
            for i, c in enumerate(HIT_SCHEMA.names)]
    return event_cells(spark, sf_dir).select(*cols, DATASET)


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit rows straight from the table, parsed and checked like rows of hit files."""
    return parse_hits(event_hit_rows(spark, sf_dir), structure=F.col("c0"), key="k")


def supplier_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second universe whose catalogue (all nations) can contain datasets with no structure:
    structure = s_suppkey, dataset = nation name."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .select(F.col("s_suppkey").alias(STRUCTURE), F.col("n_name").alias(DATASET)))


def supplier_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias(STRUCTURE), F.col("l_discount").alias(SCORE),
        F.concat_ws(".", "l_returnflag", "l_linestatus").alias(CODE))


def nation_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of dataset names: nations, and regions, which no supplier belongs to."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias(DATASET))
    return nations.unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias(DATASET)))


def order_hits_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem hits with a check: a hit of full quantity on an open line counts as malformed."""
    bad = (F.col("l_quantity") == 50) & (F.col("l_linestatus") == "O")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(STRUCTURE), F.col("l_quantity").alias(SCORE), bad.alias(BAD))


def listed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose hit file exists: pending ones have none yet."""
    return (table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
            .select(F.col("o_orderkey").alias(STRUCTURE)))


def lineitem_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order ``(float_value, count_dict)``: mean quantity and hits per code, the row shape of
    the two benchmark formulations."""
    per = (lineitem_hits(spark, sf_dir).groupBy(STRUCTURE, CODE)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(SCORE).alias("s")))
    return (per.groupBy(STRUCTURE).agg(
        (F.sum("s") / F.sum("n")).alias("float_value"),
        F.map_from_entries(F.collect_list(F.struct(CODE, "n"))).alias("count_dict"))
        .select("float_value", "count_dict"))
