"""Exact quantiles (NumPy 'linear' method) by radix selection.

Spark's exact ``percentile`` merges every distinct value of a group in one
task. Here each wanted order statistic is found digit by digit: a double's
order-preserving 64-bit key (its bits, mirrored below zero) has four digits of
``DIGIT`` = 16 bits. A pass counts the values that share the digits found so
far by their next digit and keeps the digit in which the wanted rank falls, so
four passes do whatever the values are. Counting is a partial aggregation: no
group, value or digit is gathered in one task, whatever repeats; there are at
most 65,536 counts per prefix. The points are written once, not derived again
by every pass; all groups, columns and quantiles share the passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqprep.plans.rank import null_safe_join
from seqprep.plans.state import State, materialize

DIGIT = 16
PASSES = 64 // DIGIT


def ordered_key(x: Column) -> Column:
    """The bits of a finite double as a long in the order of the doubles (both
    zeros are 0), by exact scaling with powers of two."""
    a = F.abs(x)
    far = F.when(a >= 2.0**1000, F.lit(-600)).when(a < 2.0**-900, F.lit(600)).otherwise(F.lit(0))
    # 2**600 twice would leave the range, so very small numbers are scaled once
    near = a * F.pow(F.lit(2.0), far)
    guess = F.floor(F.log2(near))
    lead = near / F.pow(F.lit(2.0), guess)
    # the logarithm may be off by one beside a power of two
    exponent = guess + F.when(lead >= 2, 1).when(lead < 1, -1).otherwise(0) - far
    bits = (exponent + 1023).cast("long")
    fraction = near / F.pow(F.lit(2.0), exponent + far) - 1
    normal = F.shiftleft(bits, 52) + (fraction * 2.0**52).cast("long")
    subnormal = (a * 2.0**537 * 2.0**537).cast("long")
    key = F.when(a == 0, F.lit(0).cast("long")).when(a < 2.0**-1022, subnormal).otherwise(normal)
    return F.when(x < 0, -key).otherwise(key)


def exact_quantiles(
    values: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    out_prefix: str = "q",
) -> DataFrame:
    """One row per group (NULL keys form a group): ``n`` and ``{out_prefix}{i}``
    for each prob. ``values`` must hold finite doubles; NULLs are left out."""
    g = list(group_cols)
    points = values.select(*g, F.col(value_col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if not g:
        points, g = points.withColumn("_g", F.lit(0)), ["_g"]
    points = materialize(points.withColumn("_k", ordered_key(F.col("_x"))), measure=False).df
    # the first counts are read twice: for the number of values and for the first digit
    counted = materialize(_count(points.withColumn("_p", F.lit(0).cast("long")), [*g, "_p"], 1), measure=False).df
    base = counted.groupBy(*g).agg(F.sum("_c").alias("_n"))
    wanted = _narrow(counted, g, _ranks(base, g, probs))
    for turn in range(2, PASSES + 1):
        spans = wanted.side_for(wanted.df.select(*g, "_p").distinct())
        inside = null_safe_join(points.withColumn("_p", _prefix(turn - 1)), spans, [*g, "_p"])
        wanted = _narrow(_count(inside, [*g, "_p"], turn), g, wanted.df)

    at = [F.max(F.when(F.col("_i") == i, F.col("_x"))).alias(f"_v{i}") for i in range(2 * len(probs))]
    wide = null_safe_join(base, wanted.df.groupBy(*g).agg(*at), g)
    out = []
    for i, p in enumerate(probs):
        a, b, pos = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}"), F.lit(float(p)) * (F.col("_n") - 1)
        gamma = pos - F.floor(pos)
        out.append(F.when(gamma >= 0.5, b - (b - a) * (1 - gamma)).otherwise(a + (b - a) * gamma).alias(f"{out_prefix}{i}"))
    return wide.select(*group_cols, F.col("_n").alias("n"), *out)


def _prefix(digits: int) -> Column:
    return F.shiftright("_k", 64 - DIGIT * digits)


def _ranks(base: DataFrame, g: list[str], probs: Sequence[float]) -> DataFrame:
    """The two order statistics around each quantile: ``_i`` and its rank ``_r``."""
    ranks = F.array(*[
        F.struct(F.lit(2 * i + h).alias("i"), F.least(F.floor(F.lit(float(p)) * (F.col("_n") - 1)) + h, F.col("_n") - 1).alias("r"))
        for i, p in enumerate(probs) for h in (0, 1)
    ])
    return base.select(*g, F.lit(0).cast("long").alias("_p"), F.explode(ranks).alias("_w")).select(
        *g, "_p", F.col("_w.i").alias("_i"), F.col("_w.r").alias("_r"))


def _count(points: DataFrame, by: list[str], turn: int) -> DataFrame:
    """Values by their first ``turn`` digits, with one of them (after the last
    pass they are all the same)."""
    return points.groupBy(*by, _prefix(turn).alias("_next")).agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_x"))


def _narrow(counted: DataFrame, g: list[str], wanted: DataFrame) -> State:
    """The next digit of each wanted rank, and the rank among the values that share it."""
    span = [*g, "_p"]
    upto = F.sum("_c").over(Window.partitionBy(*span).orderBy("_next"))
    ranged = counted.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_c"))
    hit = null_safe_join(ranged, wanted.select(*span, "_i", "_r"), span).where("_r >= _before AND _r < _upto")
    return materialize(hit.select(*g, F.col("_next").alias("_p"), "_i", (F.col("_r") - F.col("_before")).alias("_r"), "_x"))
