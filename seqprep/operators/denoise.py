"""Robust-z denoising of sequences (spike segments → straight ramps → smoothing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.functions import sqlx as S
from seqprep.functions.arrays import let, linspace_at, median, moving_average
from seqprep.sources.schema import require_columns

# Robust z-score scale factor.
MAD_SCALE = 0.6745


def robust_denoise(
    df: DataFrame,
    columns: list[str],
    z_threshold: float = 3.5,
    min_segment_length: int = 2,
    smoothing_window: int = 5,
) -> DataFrame:
    """Per sequence: ``z = 0.6745·(x − median)/MAD`` (MAD 0 → 1); runs of
    ``|z| > z_threshold`` at least ``min_segment_length`` long are replaced by
    a ramp from the left to the right neighbour, both included (a run at an
    edge uses its only neighbour twice); then a centred moving average.
    Sequences shorter than 3 are returned unchanged. A sequence holding NaN has
    a NaN median, so no point is flagged (as in NumPy).

    Runs never touch each other (a neighbour is by definition not flagged),
    so each point is rewritten independently: no sequential state.
    """
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"Column '{c}' not found")
    require_columns(df, columns, "robust_denoise")
    out = df
    for c in columns:
        x = F.col(c)
        # every per-row value used inside a per-point lambda is bound once
        # per row (``let``), never read from a staged column inside the lambda
        out = out.withColumn("_med", median(c))
        out = out.withColumn("_mad", median(S.let("_med", lambda md: f"transform({c}, d -> abs(d - {md}))")))

        def runs_of(mm):
            mad = f"(CASE WHEN {mm}.mad > 0 THEN {mm}.mad ELSE 1.0D END)"
            v = S.var("v")
            return S.mask_runs(
                f"transform({c}, {v} -> abs({MAD_SCALE!r}D * ({v} - {mm}.med) / {mad}) > {float(z_threshold)!r}D)")

        out = out.withColumn("_runs", F.filter(F.expr(S.let("named_struct('med', _med, 'mad', _mad)", runs_of)),
                                               lambda r: r["end"] - r["start"] >= min_segment_length))
        n = F.size(x)

        def ramp(runs):
            def point(v, i):
                def on_hit(hit):
                    r = hit[0]
                    s, e = r["start"], r["end"]
                    left = F.when(s > 0, x[s - 1]).otherwise(x[e])
                    right = F.when(e < n, x[e]).otherwise(x[s - 1])
                    return F.when(F.size(hit) == 0, v).otherwise(linspace_at(left, right, e - s, i - s))

                return let(F.filter(runs, lambda r: (i >= r["start"]) & (i < r["end"])), on_hit)

            return F.transform(x, point)

        out = out.withColumn("_ramped", let(F.col("_runs"), ramp))
        smoothed = moving_average("_ramped", smoothing_window) if smoothing_window > 1 else F.col("_ramped")
        short = (F.coalesce(F.size(x), F.lit(0)) < 3)
        out = out.withColumn(c, F.when(short, F.transform(x, lambda v: v.cast("double"))).otherwise(smoothed))
        out = out.drop("_med", "_mad", "_runs", "_ramped")
    return out
