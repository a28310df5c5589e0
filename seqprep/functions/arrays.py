"""Per-sequence kernels written as Spark higher-order array functions.

Every function takes and returns ``Column`` objects, so it runs inside the
task that holds the row: no shuffle, no Python worker, and the same code
serves batch and streaming DataFrames.

Higher-order functions are interpreted, not compiled, and a sub-expression
that appears inside a lambda is evaluated again for every element. ``let``
binds a value once per row and hands it to a lambda; kernels use it for every
shared sub-expression (sorted copies, padded copies, valid positions).

The large kernels (interpolation, fills, rolling statistics, runs) take a
column name or SQL expression and are emitted as one SQL expression
(``seqprep.functions.sqlx``): one call to build, instead of hundreds of
driver-to-JVM calls for a nested Column tree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqprep.functions import sqlx as S
from seqprep.functions.missing import NAN


def EMPTY_INT() -> Column:  # noqa: N802
    return F.array().cast("array<int>")


def EMPTY_DOUBLE() -> Column:  # noqa: N802
    return F.array().cast("array<double>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def positions(seq: Column) -> Column:
    """``[0, 1, …, size-1]``; empty for empty or NULL input.

    ``sequence(0, -1)`` counts down in Spark, so the empty case is guarded.
    """
    n = F.size(seq)
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(EMPTY_INT())


def seq_len(seq: Column) -> Column:
    """Length with NULL counted as 0 (``size(NULL)`` is NULL under ANSI)."""
    return F.coalesce(F.size(seq), F.lit(0))


# --------------------------------------------------------------------------
# statistics of one sequence
# --------------------------------------------------------------------------

def seq_sum(seq: Column) -> Column:
    return F.aggregate(seq, F.lit(0.0), lambda acc, x: acc + x)


def seq_mean(seq: Column) -> Column:
    """Arithmetic mean; NaN for an empty sequence, NaN propagates."""
    n = F.size(seq)
    return F.when(n > 0, seq_sum(seq) / n).otherwise(NAN())


def seq_var_pop(seq: Column, mean: Column) -> Column:
    """Population variance around a precomputed mean (two-pass, stable)."""
    n = F.size(seq)
    ss = F.aggregate(seq, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n > 0, ss / n).otherwise(NAN())


def seq_cov_pop(x: Column, y: Column, mean_x: Column, mean_y: Column) -> Column:
    """Population covariance of two equal-length sequences."""
    n = F.size(x)
    s = F.aggregate(
        F.arrays_zip(x.alias("a"), y.alias("b")),
        F.lit(0.0),
        lambda acc, p: acc + (p["a"] - mean_x) * (p["b"] - mean_y),
    )
    return F.when(n > 0, s / n).otherwise(NAN())


def nan_median(seq: str) -> Column:
    """Median of the finite points (NumPy ``nanmedian``); NaN when none."""
    return F.expr(S.nan_median(seq))


def median(seq: str) -> Column:
    """NumPy ``median``: NaN as soon as one point is NaN."""
    return F.expr(S.median(seq))


# --------------------------------------------------------------------------
# order-dependent kernels within a sequence
# --------------------------------------------------------------------------

def interpolate(y: str) -> Column:
    """Linear interpolation over missing points by index; edges take the
    nearest valid value; all-missing or nothing-missing sequences unchanged.
    ``y`` names a canonical (missing = NaN) double array column."""
    return F.expr(S.interpolate(y))


def neighbor_mean_fill(y: str) -> Column:
    """Forward/backward fill where an inner gap takes the mean of the previous
    and the next valid value (not a linear ramp); edges take the nearest."""
    return F.expr(S.neighbor_mean_fill(y))


def rolling_median(y: str, window: int) -> Column:
    """Centred rolling ``nanmedian`` with edge padding of ``window // 2``;
    window <= 1 or an empty sequence returns ``y``. Even windows are
    off-centre, as in the reference."""
    return F.expr(S.rolling_median(y, window))


def moving_average(y: str, window: int) -> Column:
    """Centred moving average with edge padding (odd windows only: an even
    window would return one point more than the input)."""
    return F.expr(S.moving_average(y, window))


def running_sum(y: str, kind: str = "double") -> Column:
    """Running sum along a sequence (``cumsum`` with NULL as 0)."""
    return F.expr(S.running_sum(y, kind))


def mask_runs(mask: str) -> Column:
    """Runs of true values of a boolean array as ``array<struct<start, end>>``
    (half-open)."""
    return F.expr(S.mask_runs(mask))


def linspace_at(left: Column, right: Column, count: Column, j: Column) -> Column:
    """Element ``j`` of ``np.linspace(left, right, count)`` (endpoint included)."""
    step = (right - left) / (count - 1)
    return F.when(count == 1, left).when(j == count - 1, right).otherwise(j * step + left)
