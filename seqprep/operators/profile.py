"""Per-sequence statistics (one value per row, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.functions import sqlx as S
from seqprep.functions.arrays import let, median, seq_cov_pop, seq_mean, seq_var_pop


def sequence_stats(df: DataFrame, col: str, other: str | None = None, prefix: str | None = None) -> DataFrame:
    """Add mean, population variance and std, median, MAD (median absolute
    deviation from the median) of ``col`` and, when ``other`` is given, the
    population covariance of ``col`` and ``other``. Stages are separate
    projections so every array is scanned a fixed number of times."""
    p = prefix or col
    x = F.col(col)
    out = df.withColumn(f"{p}_mean", seq_mean(x))
    m = F.col(f"{p}_mean")
    # values used inside a lambda are bound once per row with ``let``
    out = out.withColumn(f"{p}_var", let(m, lambda mv: seq_var_pop(x, mv))).withColumn(f"{p}_std", F.sqrt(F.col(f"{p}_var")))
    out = out.withColumn(f"{p}_median", median(col))
    out = out.withColumn(f"{p}_mad", median(S.let(f"{p}_median", lambda md: f"transform({col}, d -> abs(d - {md}))")))
    if other:
        cov = let(F.struct(m.alias("a"), seq_mean(F.col(other)).alias("b")),
                  lambda mm: seq_cov_pop(x, F.col(other), mm["a"], mm["b"]))
        out = out.withColumn(f"{p}_cov_{other}", cov)
    return out
