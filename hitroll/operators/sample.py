"""Keyed Bernoulli sample (FLT4): whether a row is taken depends on its key alone, so a sample can
be repeated on any engine, does not depend on partitioning, and survives a lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 8      # hexadecimal digits of the key's MD5 that are compared


def threshold(fraction: float) -> str:
    return format(min(int(fraction * 16 ** DIGITS), 16 ** DIGITS - 1), f"0{DIGITS}x")


def keyed_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Rows whose key's hash falls in the lowest ``fraction``; another ``salt``, another sample."""
    h = F.substring(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), 1, DIGITS)
    return df.where(h < F.lit(threshold(fraction)))
