"""Per-structure scores, the three-state outcome, and per-dataset statistics.

Plan shape (checked with ``explain``): hits are partially aggregated map-side before the only
shuffle of hit rows, so a structure that holds a third of all hits still moves one row per map
task; the aggregated side is hash-partitioned on ``structure`` and the join with the structure
universe reuses that partitioning (only the universe is exchanged). The dataset level works on
one row per structure, again with partial aggregation, so a dominant dataset is harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitroll.schema import (BAD, CODE, DATASET, HITS, NO_OUTPUT, REASON, REJECTED, SCORE,
                            SCORED_OUTCOMES, STRUCTURE, ZERO_HITS)


def keys_of(df: DataFrame) -> list[str]:
    """A structure is known by its dataset and its name: two datasets may hold files of one name.
    Tables without a dataset column (one dataset, or ids unique across datasets) key by name."""
    return [DATASET, STRUCTURE] if DATASET in df.columns else [STRUCTURE]


def _bad(hits: DataFrame) -> Column:
    return F.col(BAD) if BAD in hits.columns else F.lit(False)


def per_structure(hits: DataFrame) -> DataFrame:
    """AG1 + AG6 + FLT6: one row per structure that has hit rows.

    ``n_hits`` rows, ``mean_score`` (mean over all rows, NaN propagates as in the reference),
    ``rejected`` when any row is bad (the whole structure then has no output, R7).
    """
    return (hits.groupBy(*keys_of(hits))
            .agg(F.count(F.lit(1)).alias("n_hits"),
                 F.avg(SCORE).alias("mean_score"),
                 F.bool_or(_bad(hits)).alias("rejected")))


def outcomes(structures: DataFrame, per: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """JN1 + R1: the three per-structure outcomes over the whole structure universe.

    ``structures``: (structure, dataset), one row per structure.
    ``per``: output of :func:`per_structure`.
    ``listed``: optional (structure) or (dataset, structure) rows for structures whose hit file exists. Without it, a
    structure with no hit rows counts as "zero hits" (table-sourced hits). With it, a structure
    that has no listed file has "no output".

    Returns (structure, dataset, outcome, n_hits, mean_score): ``mean_score`` is the mean for
    "hits", 0.0 for "zero_hits" and NULL for "no_output" / "rejected".
    """
    j = structures.join(per, keys_of(per), "left")
    if listed is not None:
        keys = keys_of(listed)
        flag = listed.select(*keys).distinct().withColumn("_listed", F.lit(True))
        j = j.join(flag, keys, "left")
        has_file = F.coalesce(F.col("_listed"), F.lit(False))
    else:
        has_file = F.lit(True)
    outcome = (F.when(F.coalesce(F.col("rejected"), F.lit(False)), F.lit(REJECTED))
                .when(~has_file, F.lit(NO_OUTPUT))
                .when(F.col("n_hits").isNull(), F.lit(ZERO_HITS))
                .otherwise(F.lit(HITS)))
    mean = (F.when(outcome == HITS, F.col("mean_score"))
             .when(outcome == ZERO_HITS, F.lit(0.0)))
    return j.select(STRUCTURE, DATASET, outcome.alias("outcome"),
                    F.coalesce(F.col("n_hits"), F.lit(0)).cast("long").alias("n_hits"),
                    mean.alias("mean_score"))


def scored(outcome_df: DataFrame) -> DataFrame:
    """FLT1: keep structures that count in the statistics (hits or zero hits)."""
    return outcome_df.where(F.col("outcome").isin(*SCORED_OUTCOMES))


def dataset_statistics(scored_df: DataFrame, catalogue: DataFrame | None = None,
                       value: str = "mean_score") -> DataFrame:
    """AG4 + AG5 + AG6 + AG9 + AG16: per dataset, the mean and population standard deviation of
    the per-structure means, and the number of scored structures.

    ``stddev_pop`` uses central moments, so equal inputs give 0.0, not a negative variance (R4).
    With a ``catalogue`` (dataset names), datasets with nothing scored still get a row with
    0.0 / 0.0 / 0 (R5); without one, empty datasets are simply absent.
    """
    agg = (scored_df.groupBy(DATASET)
           .agg(F.avg(value).alias("mean_score"),
                F.stddev_pop(value).alias("std_score"),
                F.count(F.lit(1)).alias("n_structures")))
    if catalogue is not None:
        agg = catalogue.select(DATASET).distinct().join(agg, DATASET, "left")
    return agg.select(DATASET,
                      F.coalesce("mean_score", F.lit(0.0)).alias("mean_score"),
                      F.coalesce("std_score", F.lit(0.0)).alias("std_score"),
                      F.coalesce("n_structures", F.lit(0)).cast("long").alias("n_structures"))


def sample_statistics(scored_df: DataFrame, value: str = "mean_score") -> DataFrame:
    """AG12 + AG17: mean and *sample* standard deviation, 0.0 when a dataset has one value
    (the notebook's benchmark form)."""
    return (scored_df.groupBy(DATASET)
            .agg(F.avg(value).alias("mean_score"),
                 F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std_score"),
                 F.count(F.lit(1)).alias("n_structures")))


def code_counts(hits: DataFrame) -> DataFrame:
    """AG2: hits per (structure, code). Partial aggregation first, so hot structures are cheap."""
    return hits.groupBy(*keys_of(hits), CODE).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------- single pass at the code grain

def code_grain(hits: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """One aggregation of the hit rows at (structure, [extra keys], code) grain:
    ``n`` rows, ``s`` score total, and ``bad`` (any row bad) when the hits carry validation.

    Later levels (per structure, per dataset and code) derive from this much smaller table.
    The map-side partial aggregation keeps a hot structure to one row per code per task.
    """
    keys = [*keys_of(hits), *(extra_keys or []), CODE]
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(SCORE).alias("s")]
    if BAD in hits.columns:
        aggs.append(F.bool_or(BAD).alias(BAD))
    if REASON in hits.columns:          # at most one entry per rejection reason
        aggs.append(F.collect_set(REASON).alias("reasons"))
    return hits.groupBy(*keys).agg(*aggs)


def rejects_from_grain(grain: DataFrame) -> DataFrame:
    """Rejected structures (n_bad, n_rows, reasons) from a grain of validated hits. Bad rows
    have no code, so they sit in the grain rows whose code is NULL."""
    return (grain.groupBy(*keys_of(grain))
            .agg(F.sum(F.when(F.col(BAD), F.col("n")).otherwise(F.lit(0))).alias("n_bad"),
                 F.sum("n").alias("n_rows"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("reasons"))))
                 .alias("reasons"))
            .where(F.col("n_bad") > 0))


def per_structure_from_grain(grain: DataFrame) -> DataFrame:
    """Same columns as :func:`per_structure`, from :func:`code_grain`. The mean is
    ``sum(s) / sum(n)``, equal to the row mean for every structure that is not rejected."""
    rej = F.bool_or(BAD) if BAD in grain.columns else F.lit(False)
    return (grain.groupBy(*keys_of(grain))
            .agg(F.sum("n").alias("n_hits"),
                 (F.sum("s") / F.sum("n")).alias("mean_score"),
                 rej.alias("rejected")))


def accepted(grain: DataFrame) -> DataFrame:
    """Grain rows of structures with no bad row (R7): the rejected structures, normally few, are
    anti-joined. No structure's rows are gathered. Both sides compute the grain unless it has been
    written, as the job does; write one whose rows are dear to make."""
    if BAD not in grain.columns:
        return grain
    rejected = grain.where(F.col(BAD)).select(*keys_of(grain)).distinct()
    return grain.drop(BAD, "reasons").join(rejected, keys_of(grain), "left_anti")


def code_totals(grain: DataFrame, structures: DataFrame | None = None) -> DataFrame:
    """AG7 + R6 + R7 in one pass over the grain: total hits per (dataset, code) of accepted
    structures. ``structures`` (structure, dataset) restricts to the universe and supplies the
    dataset where the grain has none."""
    g = accepted(grain).where(F.col(CODE).isNotNull())
    if structures is not None:
        g = g.join(structures.select(STRUCTURE, DATASET), keys_of(g))
    return (g.groupBy(DATASET, CODE).agg(F.sum("n").alias("count"))
            .where(F.col("count") > 0))
