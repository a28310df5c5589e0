"""One rule for missing points in double sequences.

A point is missing when it is NULL, NaN or +/-infinity. Every kernel first
rewrites missing points to NaN (``canonical``) so later steps test one value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def NAN() -> Column:  # noqa: N802 - constant-like
    return F.lit(float("nan"))


def POS_INF() -> Column:  # noqa: N802
    return F.lit(float("inf"))


def NEG_INF() -> Column:  # noqa: N802
    return F.lit(float("-inf"))


def is_missing(x: Column) -> Column:
    """True for NULL, NaN and +/-inf (never NULL itself)."""
    return x.isNull() | F.isnan(x) | (F.abs(x) == POS_INF())


def is_finite(x: Column) -> Column:
    return ~is_missing(x)


def canonical(seq: Column) -> Column:
    """Double sequence with every missing point as NaN; NULL stays NULL."""
    return F.transform(seq, lambda x: F.when(is_missing(x), NAN()).otherwise(x.cast("double")))
