"""Head, exact seeded row choice and seeded shuffle rank."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.functions import rng
from seqprep.plans.rank import rank_bands


def head(df: DataFrame, n: int, order_by: str = "id") -> DataFrame:
    """First ``n`` rows by a key (a top-k: Spark keeps k rows per task)."""
    return df.orderBy(order_by).limit(n)


def shuffle_key(seed: int, key: str = "id") -> Column:
    """Seeded shuffle order of a row: a 32-bit hash of (seed, key)."""
    return rng.u32(F.lit(seed), F.col(key))


def with_shuffle_band(
    df: DataFrame,
    seed: int,
    cuts: Callable[[Column], list[Column]],
    key: str = "id",
    group_cols: Sequence[str] = (),
    out: str = "band",
) -> DataFrame:
    """``out``: how many of the rank cuts lie at or below the row's exact rank
    in a seeded shuffle of its group (order: hash of (seed, key), then key)."""
    h = df.withColumn("_h", shuffle_key(seed, key))
    return rank_bands(h, group_cols, ["_h", key], cuts, out=out).drop("_h")


def choose_rows(
    df: DataFrame, fraction: float, seed: int, key: str = "id", group_cols: Sequence[str] = (), out: str = "chosen"
) -> DataFrame:
    """Mark exactly ``max(1, int(n·fraction))`` rows per group, without
    replacement, by seeded shuffle order. ``fraction >= 1`` marks all rows.
    Rows that repeat a key are marked alike (so a few more may be)."""
    if fraction >= 1.0:
        return df.withColumn(out, F.lit(True))

    def cuts(n):
        return [F.greatest(F.lit(1).cast("long"), F.floor(n * F.lit(float(fraction))))]

    return with_shuffle_band(df, seed, cuts, key=key, group_cols=group_cols, out=out).withColumn(out, F.col(out) == 0)
