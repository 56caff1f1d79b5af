"""Named-dataset catalogue (SRC10, FLT5, SET3, JN5).

A catalogue is a small table ``(dataset, path, min_partitions)``. Requested names are
normalised (strip + lower, R14); unknown names raise ``ValueError`` listing the valid ones;
repeats are processed once. The catalogue is metadata (one row per dataset), so holding its
names on the driver is bounded by the number of datasets, not by data size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.fixed import DEFAULT_MIN_PARTITIONS
from hitroll.functions.columns import normalise_name
from hitroll.schema import DATASET, STRUCTURE


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    min_partitions: int = DEFAULT_MIN_PARTITIONS


def catalogue_df(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    return spark.createDataFrame([(e.name.strip().lower(), e.path, e.min_partitions) for e in entries],
                                 f"{DATASET} string, path string, min_partitions int")


def resolve(requested: list[str], entries: list[Entry]) -> list[Entry]:
    """FLT5 + SET3: normalise, de-duplicate (keeping first order), reject unknown names."""
    known = {e.name.strip().lower(): e for e in entries}
    names = list(dict.fromkeys(n.strip().lower() for n in requested))
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"not in the catalogue: {unknown}; it has {sorted(known)}")
    return [known[n] for n in names]


def requested_entries(requested: DataFrame, catalogue: DataFrame) -> DataFrame:
    """JN5: catalogue rows of the requested names (column ``dataset``), each once."""
    req = requested.select(normalise_name(DATASET).alias(DATASET)).distinct()
    return catalogue.join(req, DATASET, "left_semi")


def unknown_names(requested: DataFrame, catalogue: DataFrame) -> DataFrame:
    """SET3 as a DataFrame: requested names (column ``dataset``) missing from the catalogue."""
    req = requested.select(normalise_name(DATASET).alias(DATASET)).distinct()
    return req.join(catalogue.select(DATASET), DATASET, "left_anti")


def derived_catalogue(structures: DataFrame, structures_per_partition: int = 256) -> DataFrame:
    """A catalogue computed from a structure universe: one row per normalised dataset name with
    its structure count and a split count for the per-record stage (PT1): one partition per
    ``structures_per_partition`` structures, at least one."""
    return (structures.groupBy(normalise_name(DATASET).alias(DATASET))
            .agg(F.count(STRUCTURE).alias("n_structures"))
            .withColumn("min_partitions",
                        F.greatest(F.lit(1), F.ceil(F.col("n_structures") / structures_per_partition))
                        .cast("long")))
