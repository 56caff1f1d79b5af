"""Per-structure code maps and their combinations (PRJ6, PRJ10, PRJ11, AG3, AG7, AG10, AG11,
AG13, AG14, JN4, SET1, SC10).

The scalable path never builds maps: code totals come from (structure, code, n) rows
(``scores.code_summary``). Maps are the per-structure *result shape* of the reference (D6), so
they are offered here, built from aggregated rows (one entry per distinct code of a structure,
bounded by the code vocabulary rather than by the number of hits), and combined in-row with
higher-order functions (no Python).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitroll.schema import CODE, STRUCTURE


def structure_maps(counts: DataFrame, n_col: str = "n") -> DataFrame:
    """AG3: (structure, codes map<code, n>) from (structure, code, n) rows with unique keys."""
    return (counts.where(F.col(CODE).isNotNull())
            .groupBy(STRUCTURE)
            .agg(F.map_from_entries(F.collect_list(F.struct(CODE, n_col))).alias("codes")))


def run_pairs(grain: DataFrame, run_col: str = "run", runs: tuple = (1, 2)) -> DataFrame:
    """Two summaries per structure from one grain ``(structure, run, code, n, s)``, side by side
    without a self-join: one aggregation by structure with conditional aggregates per run.

    Returns (structure, a, mean_a, n_a, b, mean_b, n_b): ``a``/``b`` are code maps (empty when the
    run has no hits), ``mean_*`` NULL in that case.
    """
    cols = []
    for tag, r in zip(("a", "b"), runs):
        here = F.col(run_col) == F.lit(r)
        n = F.sum(F.when(here, F.col("n")))
        cols += [F.map_from_entries(F.collect_list(F.when(here & F.col(CODE).isNotNull(),
                                                          F.struct(CODE, "n")))).alias(tag),
                 (F.sum(F.when(here, F.col("s"))) / n).alias(f"mean_{tag}"),
                 F.coalesce(n, F.lit(0)).alias(f"n_{tag}")]
    return grain.groupBy(STRUCTURE).agg(*cols)


def entries(df: DataFrame, map_col, key: str = CODE, value: str = "count",
            keep: list | tuple = ()) -> DataFrame:
    """PRJ6: one (key, value) row per map entry; empty and NULL maps give no rows.

    Written as ``explode_outer`` plus a key filter, which is exactly ``explode`` because map
    keys are never NULL. For a plain ``explode`` Catalyst infers ``size(map) > 0`` and pushes
    it below the projection that builds the map, so a computed map would be built twice, the
    second time outside generated code.
    """
    return (df.select(*keep, F.explode_outer(_c(map_col)).alias(key, value))
            .where(F.col(key).isNotNull()))


def explode_sum(df: DataFrame, map_col: str = "codes", by: list[str] | None = None) -> DataFrame:
    """PRJ6 + AG7 + AG13: explode maps to (code, count) rows and total them per code.

    Partial aggregation runs before the shuffle, so a dominant code costs one row per task.
    Empty and NULL maps contribute nothing. Totals <= 0 are dropped, as ``Counter`` does (R6).
    """
    by = by or []
    rows = entries(df, map_col, keep=by)
    return (rows.groupBy(*by, CODE).agg(F.sum("count").alias("total_count"))
            .where(F.col("total_count") > 0))


def merge_maps(a, b) -> Column:
    """AG11 / JN4: key-aligned sum of two maps, a missing key counting as 0. A NULL map (one
    side absent) counts as empty."""
    a = F.coalesce(_c(a), F.create_map().cast("map<string,bigint>"))
    b = F.coalesce(_c(b), F.create_map().cast("map<string,bigint>"))
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def positive(m) -> Column:
    """``Counter`` addition keeps only positive totals (R6)."""
    return F.map_filter(_c(m), lambda k, v: v > 0)


def combine_pair(codes_a, mean_a, codes_b, mean_b) -> tuple[Column, Column]:
    """AG10: combine two summaries: merged code counts and the midpoint of the two means.

    A two-input operation only: folding it over many inputs would weight them by fold order,
    so it is never used as a reducer (dataset means come from ``scores.dataset_statistics``).
    """
    return merge_maps(codes_a, codes_b), (_c(mean_a) + _c(mean_b)) / F.lit(2.0)


def key_union(a, b) -> Column:
    """SET1: the union of the key sets of two maps."""
    return F.array_union(F.coalesce(F.map_keys(_c(a)), F.array().cast("array<string>")),
                         F.coalesce(F.map_keys(_c(b)), F.array().cast("array<string>")))


def get_or_zero(m, key) -> Column:
    """SC10: ``d.get(k, 0)``."""
    return F.coalesce(F.element_at(_c(m), key if isinstance(key, Column) else F.lit(key)), F.lit(0))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
