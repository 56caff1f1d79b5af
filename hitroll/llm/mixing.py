"""Mixing sources to target weights by temperature.

Source weights are token shares raised to an exponent and normalised: 1 keeps the natural mix, 0
makes it uniform. The exponent is found by repeated sectioning of [0, 1]: the largest that reaches
the target entropy, raised where needed until no source repeats more often than allowed. Each pass
evaluates all section points in one aggregation over the table of sources.

The weights are then realised as budgeted block permutations. A source with weight w and T tokens
takes part in ``E = budget * w / T`` epochs. Whole epochs use every document once; for the rest the
documents of a source are dealt to blocks by hash, the blocks are put in a pseudo-random order, and
blocks are taken in that order while the budget lasts; the block at the edge is taken document by
document in a second hash order. Per source this comes down to four numbers, so the documents meet
only a small table. Without a given budget, the least repeated source is read exactly once, so no
document is lost.

Defined results: tokens are white-space separated words; null or empty text has none and appears
once per whole epoch; null source is a source of its own; rows of one ``doc_id`` go together;
sources without tokens appear once; an empty table gives no rows; other columns stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitroll.llm.common import cut, tuck, untuck, words_of

MAX_EPOCHS = 2.0
SECTIONS, PASSES = 32, 5
BLOCK_ROWS = 1000
BLOCKS_PER_ROOT = 64  # from 4 billion documents on, blocks grow with 64 times their root, so that neither
                      # the row of blocks nor a block outgrows a task
SEED = 20_26


def source_totals(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source").agg(F.sum("tokens").cast("double").alias("total"),
                                       F.count(F.lit(1)).alias("n"))


def _profile(totals: DataFrame, points: list[float], budget: float | None) -> list[tuple]:
    """Per exponent: entropy of the weights (nats) and the most epochs of any source."""
    q = F.col("total") / F.col("all")
    powers = [F.pow(q, F.lit(a)) for a in points]
    aggs = []
    for p in powers:
        aggs += [F.sum(p), F.sum(p * F.log(q)), F.max(p / q), F.min(p / q)]
    row = totals.agg(*aggs).first()
    out = []
    for i, a in enumerate(points):
        z, zlog, most, least = row[4 * i:4 * i + 4]
        epochs = most / least if budget is None else budget * most / z
        out.append((math.log(z) - a * zlog / z, epochs))
    return out


def find_exponent(totals: DataFrame, target_entropy: float | None = None,
                  max_epochs: float = MAX_EPOCHS, budget: float | None = None) -> float:
    """The smallest exponent whose weights repeat no source beyond ``max_epochs`` and, with a
    target, whose entropy has come down to it. ``budget`` is a multiple of all tokens."""
    grand = totals.agg(F.sum("total")).first()[0]
    if not grand:
        return 1.0
    shares = cut(totals.where("total > 0").withColumn("all", F.lit(grand)), "shares")
    def fits(entropy: float, epochs: float) -> bool:
        return epochs <= max_epochs * (1 + 1e-12) and (
            target_entropy is None or entropy <= target_entropy + 1e-12)

    low, high = 0.0, 1.0
    for _ in range(PASSES):
        points = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        good = [p for p, made in zip(points, _profile(shares, points, budget)) if fits(*made)]
        if not good:                      # not even the natural mix meets it
            return 1.0
        high = good[0]
        if high == low:
            break
        low = points[points.index(high) - 1]
    return high


def _block(n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(SEED)), n_blocks)


def _place(block: Column) -> Column:
    """Place of a block in the permutation of its source's blocks."""
    return F.xxhash64(F.coalesce("source", F.lit("\x00")), block, F.lit(SEED + 1))


def _within() -> Column:
    return F.xxhash64("doc_id", F.lit(SEED + 2))


def mixing_plan(sized: DataFrame, target_entropy: float | None = None,
                max_epochs: float = MAX_EPOCHS, budget: float | None = None) -> DataFrame:
    """Per source: ``weight, epochs, whole, n_blocks`` and where the last, partial epoch ends
    (``last_place``, ``edge_place``, ``edge_within``). ``sized``: ``doc_id, source, tokens``."""
    totals = cut(source_totals(sized), "source-totals")
    exponent = find_exponent(totals, target_entropy, max_epochs, budget)
    every = totals.agg(F.sum("total").alias("t"),
                       F.sum(F.when(F.col("total") > 0, 1)).alias("n")).first()
    q = F.when(F.col("total") > 0, F.col("total") / F.lit(every["t"] or 1.0))
    raw = totals.withColumn("raw", F.pow(q, F.lit(exponent)))
    z, least = raw.agg(F.sum("raw"), F.min(F.col("raw") / q)).first()
    z, least = z or 1.0, least or 1.0
    scale = 1.0 / least if budget is None else budget / z
    plan = raw.select(
        "source", "total", F.coalesce(F.col("raw") / F.lit(z), F.lit(0.0)).alias("weight"),
        F.coalesce(F.round(F.col("raw") / q * F.lit(scale), 9), F.lit(1.0)).alias("epochs"),
        F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(16.0), F.least(
            F.col("n") / BLOCK_ROWS, BLOCKS_PER_ROOT * F.sqrt("n")))))).cast("long").alias("n_blocks"))
    plan = cut(plan.withColumn("whole", F.floor("epochs").cast("int"))
               .withColumn("want", (F.col("epochs") - F.col("whole")) * F.col("total")), "mix")

    with_plan = sized.join(plan.select(F.col("source").alias("__s"), "n_blocks"),
                           sized["source"].eqNullSafe(F.col("__s"))).drop("__s")
    blocks = (with_plan.withColumn("place", _place(_block(F.col("n_blocks"))))
              .groupBy("source", "place").agg(F.sum("tokens").alias("tokens")))
    order = Window.partitionBy("source").orderBy("place")
    blocks = blocks.withColumn("upto", F.sum("tokens").over(order))
    ends = plan.select(F.col("source").alias("__s"), "want")
    blocks = blocks.join(ends, blocks["source"].eqNullSafe(F.col("__s"))).drop("__s")
    edges = blocks.where("want > 0").groupBy("source").agg(
        F.max(F.when(F.col("upto") <= F.col("want"), F.col("place"))).alias("last_place"),
        F.min(F.when(F.col("upto") > F.col("want"), F.col("place"))).alias("edge_place"),
        F.max(F.when(F.col("upto") <= F.col("want"), F.col("upto"))).alias("taken"),
        F.max("want").alias("want"))
    plan = cut(plan.drop("want").join(edges.withColumnRenamed("source", "__s"),
                                      F.col("source").eqNullSafe(F.col("__s")), "left")
               .drop("__s"), "mix-edges")
    # Inside the block at the edge: documents in hash order while tokens are left.
    edge = sized.join(plan.select(F.col("source").alias("__s"), "n_blocks", "edge_place",
                                  (F.col("want") - F.coalesce("taken", F.lit(0))).alias("left")),
                      sized["source"].eqNullSafe(F.col("__s"))).drop("__s")
    edge = edge.where(_place(_block(F.col("n_blocks"))) == F.col("edge_place"))
    edge = edge.withColumn("within", _within())
    edge = edge.withColumn("upto", F.sum("tokens").over(
        Window.partitionBy("source").orderBy("within")))
    edge = (edge.where(F.col("upto") <= F.col("left")).groupBy(F.col("source").alias("__s"))
            .agg(F.max("within").alias("edge_within")))
    return cut(plan.join(edge, F.col("source").eqNullSafe(F.col("__s")), "left")
               .drop("__s", "want", "taken", "total"), "mix-plan")


def mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` with a row per document and epoch, ``__epoch`` and ``__place`` (order by epoch and
    place to read the mix in its order), ``__weight``."""
    names = ("weight", "epochs", "whole", "n_blocks", "last_place", "edge_place", "edge_within")
    plan = plan.select(F.col("source").alias("__s"), *[F.col(c).alias(f"__{c}") for c in names])
    df = docs.join(plan, docs["source"].eqNullSafe(F.col("__s"))).drop("__s")
    place = _place(_block(F.col("__n_blocks")))
    extra = ((place <= F.col("__last_place"))
             | ((place == F.col("__edge_place")) & (_within() <= F.col("__edge_within"))))
    copies = F.col("__whole") + F.when(extra, 1).otherwise(0)
    df = df.withColumn("__copies", copies).where("__copies > 0")
    df = df.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    drop = [f"__{c}" for c in names if c != "weight"]
    return df.withColumn("__place", place).drop("__copies", *drop)


def sized_docs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long")
                       .alias("tokens"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` repeated to the mix, with their own columns."""
    plan = mixing_plan(cut(sized_docs(docs), "sized"), **settings)
    return untuck(mix(tuck(docs, "doc_id", "source"), plan), docs)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = cut(sized_docs(spark.read.parquet(f"{sf_dir}/documents.parquet")), "sized")
    mixed = mix(sized, mixing_plan(sized))
    return mixed.select("doc_id", "source", "tokens", F.col("__epoch").alias("epoch"),
                        F.col("__place").alias("place"),
                        F.round("__weight", 9).alias("weight"))
