"""Exact means (R19): the mean of doubles as the nearest double to their exact rational mean.

A double is an integer times a power of two. Values are scaled by a power of two that depends only
on their band (7 binary orders of magnitude), which makes them whole numbers below 2^61, and the
three 21-bit parts of these numbers are summed as longs. Whole-number sums do not depend on order,
so any partitioning, merge order or retry gives the same bits. The state, one row per key and band,
is mergeable: ``exact_sums`` of two batches added by ``merge_sums`` are those of both.

``exact_mean`` reads the sums of a key as one number in base 128 (a band is one digit, a part three),
carries, divides by the count digit by digit and rounds once, half to even. Everything is native
expressions; the arrays it works on have at most some 320 digits, whatever the number of rows.

Plan: one exchange of partial sums by key and band, one of a few rows per key by key. A key that
holds a third of all rows moves one row per map task and band. A key may have up to 2^40 rows;
beyond, the sums may leave the range of a long, which fails under ANSI mode and never wraps there.

Nulls are left out; a key of nulls only has a null mean. NaN, or infinities of both signs, make the
mean NaN; infinities of one sign make it infinite. Negative zero counts as zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitroll.operators.scores import _bad, keys_of
from hitroll.schema import SCORE

BAND = 7                      # bits of a digit and of a band
PART = 3 * BAND               # bits of a summed part
DIGITS = 9                    # digits that hold more than 53 bits from the first one that counts
SUMS = ("n", "d0", "d1", "d2", "n_nan", "n_up", "n_down")


def _long(x) -> Column:
    return F.lit(x).cast("bigint")


def _scaled(x: Column, power: Column) -> Column:
    """``x`` times two to the ``power``, in two steps that stay in range; powers of two are exact."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def exact_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The mergeable state: ``(*keys, band, n, d0, d1, d2, n_nan, n_up, n_down)``."""
    x = F.col(value).cast("double")
    endless = F.abs(x) == F.lit(float("inf"))
    counts = x.isNotNull() & ~F.isnan(x) & ~endless & (x != 0)
    # An order of magnitude that log2 puts one too high or too low only moves the value to the next
    # band; the scale has a bit to spare on both sides.
    band = F.when(counts, F.floor(F.floor(F.log2(F.abs(x))) / BAND)).otherwise(0).cast("int")
    rows = df.select(*keys, x.alias("_x"), band.alias("band"), counts.alias("_counts"))
    whole = F.when(F.col("_counts"), _scaled(F.col("_x"), F.lit(53) - BAND * F.col("band"))).otherwise(0.0)
    rows = rows.select(*keys, "band", "_x", whole.cast("bigint").alias("_m"))
    mask, m = _long((1 << PART) - 1), F.col("_m")
    inf = F.lit(float("inf"))
    return rows.groupBy(*keys, "band").agg(
        F.count("_x").alias("n"),
        F.sum(m.bitwiseAND(mask)).alias("d0"),
        F.sum(F.shiftright(m, PART).bitwiseAND(mask)).alias("d1"),
        F.sum(F.shiftright(m, 2 * PART)).alias("d2"),
        F.count_if(F.isnan("_x")).alias("n_nan"),
        F.count_if(F.col("_x") == inf).alias("n_up"),
        F.count_if(F.col("_x") == -inf).alias("n_down"))


def merge_sums(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of both inputs together."""
    return a.unionByName(b).groupBy(*keys, "band").agg(*(F.sum(c).alias(c) for c in SUMS))


def _carried(digits: Column) -> Column:
    """Digits 0 to 127, lowest first, and what is carried out at the top (-1 if negative)."""
    start = F.struct(F.array().cast("array<bigint>").alias("out"), _long(0).alias("carry"))

    def step(a, d):
        t = d + a["carry"]
        return F.struct(F.concat(a["out"], F.array(t.bitwiseAND(_long(127)))).alias("out"),
                        F.shiftright(t, BAND).alias("carry"))
    return F.aggregate(digits, start, step)


def _divided(digits: Column, n: Column) -> Column:
    """Long division of digits, highest first, by ``n``: the quotient's digits and the remainder."""
    start = F.struct(F.array().cast("array<bigint>").alias("out"), _long(0).alias("rest"))

    def step(a, d):
        t = a["rest"] * 128 + d
        rest = t % n
        return F.struct(F.concat(a["out"], F.array(F.floor((t - rest).cast("double") / n).cast("bigint"))).alias("out"),
                        rest.alias("rest"))
    return F.aggregate(digits, start, step)


def exact_mean(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, n, mean, mantissa, exponent)`` of the state; a finite mean is exactly
    ``mantissa * 2^exponent``, with a mantissa of 53 bits unless it is zero or subnormal."""
    s = F.struct("band", "d0", "d1", "d2")
    bits = F.length(F.bin(F.sum("n")))       # digits that sums can carry upwards, and that a quotient needs below
    per = sums.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in ("n", "n_nan", "n_up", "n_down")),
        F.collect_list(s).alias("_b"), F.min("band").alias("_lo"),
        (F.max("band") + 2 * PART // BAND + F.floor((bits + PART - 2) / BAND) + 2).cast("int").alias("_hi"),
        (F.floor(bits / BAND) + DIGITS + 1).cast("int").alias("_guard"))

    def at(p):
        def add(acc, b):
            for i in range(3):
                acc = acc + F.when(b["band"] + i * PART // BAND == p, b[f"d{i}"]).otherwise(_long(0))
            return acc
        return F.aggregate("_b", _long(0), add)

    per = per.withColumn("_d", F.transform(F.sequence("_lo", "_hi"), at))
    per = per.withColumn("_neg", _carried(F.col("_d"))["carry"] < 0)
    per = per.withColumn("_d", F.when(F.col("_neg"), F.transform("_d", lambda d: -d)).otherwise(F.col("_d")))
    per = per.withColumn("_d", F.reverse(_carried(F.col("_d"))["out"]))
    guard = F.array_repeat(_long(0), F.col("_guard"))
    per = per.withColumn("_q", _divided(F.concat("_d", guard), F.greatest("n", _long(1))))
    q = F.col("_q")["out"]
    per = per.withColumn("_at", F.array_position(F.transform(q, lambda d: d > 0), F.lit(True)).cast("int"))
    first = F.greatest("_at", F.lit(1))
    per = (per.withColumn("_v", F.aggregate(F.slice(q, first, F.lit(DIGITS)), _long(0), lambda a, d: a * 128 + d))
           .withColumn("_more", F.exists(F.slice(q, first + DIGITS, F.lit(1 << 20)), lambda d: d > 0)
                       | (F.col("_q")["rest"] > 0))
           .withColumn("_base", BAND * (F.col("_hi") - first - (DIGITS - 2)) - 53))
    # Bits to round away: down to 53, or to the last place of a subnormal.
    per = per.withColumn("_s", F.greatest(F.length(F.bin("_v")) - 53, F.lit(-1074) - F.col("_base")))
    kept = F.when(F.col("_s") < 64, F.expr("shiftright(_v, least(_s, 63))")).otherwise(_long(0))
    per = per.withColumn("_k", kept)
    rest = F.when(F.col("_s") < 64, F.expr("_v - shiftleft(_k, least(_s, 63))")).otherwise(_long(0))
    half = F.expr("shiftleft(bigint(1), least(_s, 63) - 1)")
    up = (rest > half) | ((rest == half) & (F.col("_more") | (F.col("_k") % 2 == 1)))
    per = per.withColumn("_k", F.col("_k") + F.when(up & (F.col("_s") < 64), _long(1)).otherwise(_long(0)))
    per = per.withColumn("_full", F.col("_k") == _long(1 << 53))
    zero = F.col("_k") == 0
    per = (per.withColumn("mantissa", F.when(F.col("_full"), _long(1 << 52)).otherwise(F.col("_k"))
                          * F.when(F.col("_neg"), -1).otherwise(1))
           .withColumn("exponent", F.when(zero, 0).otherwise(
               F.col("_s") + F.col("_base") + F.col("_full").cast("int")).cast("int")))
    finite = (F.col("n") > 0) & (F.col("n_nan") + F.col("n_up") + F.col("n_down") == 0)
    inf = F.lit(float("inf"))
    mean = (F.when(F.col("n") == 0, F.lit(None).cast("double"))
            .when((F.col("n_nan") > 0) | ((F.col("n_up") > 0) & (F.col("n_down") > 0)), F.lit(float("nan")))
            .when(F.col("n_up") > 0, inf).when(F.col("n_down") > 0, -inf)
            .otherwise(_scaled(F.col("mantissa").cast("double"), F.col("exponent"))))
    return per.select(*keys, "n", mean.alias("mean"), F.when(finite, F.col("mantissa")).alias("mantissa"),
                      F.when(finite, F.col("exponent")).alias("exponent"))


def exact_per_structure(hits: DataFrame) -> DataFrame:
    """``scores.per_structure`` with exact means: the same columns, ready for ``scores.outcomes``."""
    keys = keys_of(hits)
    means = exact_mean(exact_sums(hits, keys, SCORE), keys).select(*keys, F.col("mean").alias("mean_score"))
    counts = hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_hits"), F.bool_or(_bad(hits)).alias("rejected"))
    return counts.join(means, keys).select(*keys, "n_hits", "mean_score", "rejected")
